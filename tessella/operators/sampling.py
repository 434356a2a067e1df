"""Exact-count sampling and splitting, repeatable because the order is a hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import ranked


def seeded(key: str, seed: int = 0) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_sample(df: DataFrame, by: str, key: str, counts: dict[object, int], seed: int = 0) -> DataFrame:
    """As many rows of each class as asked for, or all there are; none of a class that is not listed.

    Every task sends at most the largest count of each class to the shuffle.
    """
    most = max([0, *counts.values()])
    wanted = F.coalesce(*(F.when(F.col(by) == c, F.lit(n)) for c, n in counts.items()), F.lit(0))
    rn = F.row_number().over(W.partitionBy(by).orderBy("_order", key))
    rows = df.filter(F.col(by).isin(*counts)).withColumn("_order", seeded(key, seed)).withColumn("_rn", rn).filter(F.col("_rn") <= most)
    return rows.filter(F.col("_rn") <= wanted).drop("_order", "_rn")


def stratified_split(df: DataFrame, by: str, key: str, test: float = 0.25, seed: int = 42) -> DataFrame:
    """Adds split: `test` for the given share of each class, rounded, `train` for the rest."""
    rows = ranked(df.withColumn("_order", seeded(key, seed)), by, "_order", key)
    return rows.withColumn("split", F.when(F.col("rn") <= F.round(F.lit(test) * F.col("n")), "test").otherwise("train")).drop("_order", "rn", "n")


def sample_weight(label: str, weight: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(F.lit(1.0))
