"""Ranks and running sums over a whole table without one task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import keep


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds, under each name, the sum of an expression over all rows up to and with this one.

    Rows are dealt into ranges of the order; a range needs the totals of those before it, one row each.  The order must
    tell all rows apart.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keep(df.withColumns({f"_{k}": c for k, c in sums.items()}).repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(*(F.sum(f"_{k}").alias(f"_t_{k}") for k in sums))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # as many rows as there are ranges
    offsets = totals.select("_range", *(F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums))
    within = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = ranged.join(offsets, "_range")
    return out.withColumns({k: F.sum(f"_{k}").over(within) + F.col(f"_o_{k}") for k in sums}).select(*df.columns, *sums)


def ranked(df: DataFrame, by: str, *order: str) -> DataFrame:
    """Adds rn, the place of a row among those with the same `by`, and n, their number; a hot value fills many tasks."""
    counts = df.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("n"))
    placed = running(df, [F.col(by), *map(F.col, order)], {"_all": F.lit(1)})
    first = placed.groupBy(F.col(by).alias("_g")).agg(F.min("_all").alias("_first"))
    out = placed.join(first, F.col(by).eqNullSafe(F.col("_g"))).join(counts, F.col(by).eqNullSafe(F.col("_by")))
    return out.withColumn("rn", F.col("_all") - F.col("_first") + 1).select(*df.columns, "rn", "n")
