"""Assembly of the training set from labelled tiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import require_columns
from .joins import first_by_key


def labelled(df: DataFrame, label: int, cls: str, keep_class: bool = True) -> DataFrame:
    """Adds the label, and the class unless the table brings its own."""
    df = df.withColumn("label", F.lit(label))
    return df if keep_class and "class" in df.columns else df.withColumn("class", F.lit(cls))


def union(*parts: DataFrame) -> DataFrame:
    """All rows of all tables by column name, nulls where one lacks a column, numbered by table as src."""
    numbered = [p.withColumn("src", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def deduplicated(df: DataFrame, key: str = "tile_id", seq: str = "seq") -> DataFrame:
    """One row per tile: of the first table that has it, the first row there."""
    return first_by_key(df, key, "src", seq)


def build(parts: list[DataFrame], embeddings: DataFrame, key: str = "tile_id", seq: str = "seq") -> DataFrame:
    """The training set; tables come in order of priority, and tiles without an embedding are left out."""
    for part in parts:
        require_columns(part, key, seq, "label", "class")
    rows = deduplicated(union(*parts), key, seq).filter(F.col(key).isNotNull())
    return embeddings.join(rows.select(key, "label", "class"), key)
