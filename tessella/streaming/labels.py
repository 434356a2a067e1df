"""Label state from an event log: the same reduction over a batch and over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Modes of the labelling tool.
POSITIVE, NEGATIVE, ERASE, MAPS = 1, 0, -100, 2


def label_state(events: DataFrame, *order: str) -> DataFrame:
    """(tile_idx, label): each tile's last action by `order`; an erased tile has none, and other modes do not count.

    A table of events gives the state; a stream of them gives its updates, to be written in update or complete mode.
    """
    acts = events.filter(F.col("action").isin(POSITIVE, NEGATIVE, ERASE))
    last = acts.groupBy("tile_idx").agg(F.max_by("action", F.struct(*order)).alias("label"))
    return last.filter(F.col("label") != ERASE)


def gated(events: DataFrame, mode: str = "mode", kind: str = "kind") -> DataFrame:
    """Clicks, and lasso selections, in a labelling mode."""
    return events.filter(F.col(kind).isin("click", "lasso") & (F.col(mode) != MAPS))
