"""Training and bulk scoring of the tile classifier."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import sample_weight, stratified_split


def train(rows: DataFrame, pos_weight: float = 1.0, by: str = "class", key: str = "tile_id", seed: int = 42, trees: int = 20, depth: int = 4) -> tuple[GBTClassificationModel, DataFrame]:
    """Boosted trees on the training share of (key, by, label, embedding), and all rows with their split."""
    split = stratified_split(rows, by, key, seed=seed)
    ready = split.filter("split = 'train'").select(array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"), F.col("label").cast("double").alias("label"), sample_weight("label", pos_weight).alias("w"))
    return GBTClassifier(maxIter=trees, maxDepth=depth, weightCol="w", seed=seed).fit(ready), split


def score(model: GBTClassificationModel, embeddings: DataFrame, threshold: float | None = 0.5, key: str = "tile_id") -> DataFrame:
    """(key, prediction_probability), above the threshold if one is given."""
    ready = embeddings.select(key, array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))
    out = model.transform(ready).select(key, vector_to_array("probability")[1].alias("prediction_probability"))
    return out if threshold is None else out.filter(F.col("prediction_probability") > threshold)


def without_training(predictions: DataFrame, split: DataFrame, key: str = "tile_id", exclude: str = "train") -> DataFrame:
    """Predictions of tiles that were not trained on; exclude='all' leaves out the test tiles too."""
    used = split if exclude == "all" else split.filter("split = 'train'")
    return predictions.join(used.select(key).distinct(), key, "left_anti")
