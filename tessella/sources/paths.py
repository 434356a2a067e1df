"""Names of the files that the pipelines hand to each other."""

from __future__ import annotations

import os
from datetime import datetime


def dataset(directory: str, region: str, version: str, embeddings: bool = False) -> str:
    return f"{directory}/tile_classifier_dataset_{version}_{region}{'_embeddings' if embeddings else ''}.parquet"


def predictions(directory: str, region: str, version: str, pos_weight: float, filtered: bool = False) -> str:
    return f"{directory}/tile_classifier_predictions_{version}_{region}_posw{pos_weight}{'_filtered_no_train' if filtered else ''}.parquet"


def postprocessed(directory: str, source: str, threshold: float) -> str:
    return f"{directory}/{os.path.splitext(os.path.basename(source))[0]}_prob_{threshold}_postprocess.parquet"


def exported(directory: str, kind: str, when: datetime) -> str:
    """A GeoJSON file named by the second it is written in."""
    return f"{directory}/{kind.lower()}_{when:%Y%m%d_%H%M%S}.geojson"


def labels(directory: str, kind: str) -> str:
    return f"{directory}/{kind.lower()}_labels.parquet"
