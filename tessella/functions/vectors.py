"""Arithmetic on embedding arrays as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def angular(a: Column | str, b: Column | str) -> Column:
    """sqrt(2 - 2 cos), the distance of unit vectors; null for a vector of no length."""
    cosine = dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))
    return F.when(cosine.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - F.lit(2.0) * cosine)))


def query(positive: Column | str, negative: Column | str) -> Column:
    """2 * positive - negative; without negatives, 2 * positive."""
    return F.zip_with(positive, F.coalesce(negative, F.transform(positive, lambda _: F.lit(0.0))), lambda p, n: F.lit(2.0) * p - n)


def mean(df: DataFrame, column: str = "embedding", by: str | None = None) -> DataFrame:
    """Mean vector of a table, or of each group, summed by place before anything is shuffled."""
    keys = [by] if by else []
    places = df.select(*keys, F.posexplode(column).alias("pos", "x")).groupBy(*keys, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return places.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("mean"))
