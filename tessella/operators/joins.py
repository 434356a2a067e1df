"""Joins that Spark lacks or that need care: nearest, within a distance, by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import keep


def _cells(df: DataFrame, size: float, x: str = "x", y: str = "y") -> tuple[Column, Column]:
    return F.floor(F.col(x) / size).cast("long"), F.floor(F.col(y) / size).cast("long")


def _around(df: DataFrame, size: float) -> DataFrame:
    """Each row once for its grid cell and the eight around it."""
    cx, cy = _cells(df, size)
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    return df.withColumn("step", F.explode(steps)).withColumn("cx", cx + F.col("step.i")).withColumn("cy", cy + F.col("step.j")).drop("step")


def within_anti(rows: DataFrame, others: DataFrame, distance: float, zone: str = "utm_epsg") -> DataFrame:
    """Rows that are further than `distance` metres from all others of their zone (a point at the distance goes).

    Both need `zone`, x and y, materialised.  Points meet in grid cells of the distance's size, so the join is by key.
    """
    near = _around(others.select(F.col(zone).alias("_z"), "x", "y"), distance).select("_z", F.col("cx").alias("_nx"), F.col("cy").alias("_ny"), F.col("x").alias("_ox"), F.col("y").alias("_oy"))
    cx, cy = _cells(rows, distance)
    gap = (F.col("x") - F.col("_ox")) * (F.col("x") - F.col("_ox")) + (F.col("y") - F.col("_oy")) * (F.col("y") - F.col("_oy"))
    keyed = rows.withColumn("_cx", cx).withColumn("_cy", cy)
    same = (F.col(zone) == F.col("_z")) & (F.col("_cx") == F.col("_nx")) & (F.col("_cy") == F.col("_ny")) & (gap <= distance * distance)
    return keyed.join(near, same, "left_anti").drop("_cx", "_cy")


def nearest(rows: DataFrame, others: DataFrame, key: str, other_key: str, by: str | None = "utm_epsg", cell: float | None = None, ties: bool = False) -> DataFrame:
    """(key, other_key, d2) of the nearest other of each row, with the same `by`; nulls where there is none.

    Equally near ones: the smallest other_key, or all of them with `ties`.  Rows search their grid cell and the eight
    around it; an answer nearer than a cell's width is final, the others search again in wider cells.  The answer equals
    that of comparing all pairs.  Both sides need x, y and `by`, materialised.
    """
    group = F.col(by) if by else F.lit("")
    left = keep(rows.select(F.col(key).alias("k"), group.alias("g"), "x", "y"))
    right = keep(others.select(F.col(other_key).alias("o"), group.alias("g"), F.col("x").alias("ox"), F.col("y").alias("oy")))
    extent = right.agg(F.max("ox") - F.min("ox"), F.max("oy") - F.min("oy"), F.count("*")).first()
    wide = left.agg(F.max("x"), F.min("x"), F.max("y"), F.min("y")).first()
    done: DataFrame | None = None
    if extent[2] and wide[0] is not None:
        both = right.agg(F.max("ox"), F.min("ox"), F.max("oy"), F.min("oy")).first()
        span = max(max(wide[0], both[0]) - min(wide[1], both[1]), max(wide[2], both[2]) - min(wide[3], both[3]), 1e-9)
        size = cell or max(span * 1.5 / max(extent[2], 1) ** 0.5, 1e-9)
        left_over = left.join(right.select("g").distinct(), "g", "left_semi")
        while True:
            cx, cy = F.floor(F.col("ox") / size).cast("long"), F.floor(F.col("oy") / size).cast("long")
            met = _around(left_over, size).join(right.withColumn("cx", cx).withColumn("cy", cy), ["g", "cx", "cy"])
            met = met.withColumn("d2", (F.col("x") - F.col("ox")) * (F.col("x") - F.col("ox")) + (F.col("y") - F.col("oy")) * (F.col("y") - F.col("oy")))
            if ties:
                least = met.groupBy("k").agg(F.min("d2").alias("m"))
                found = met.join(least, "k").filter("d2 = m").select("k", "o", "d2")
            else:
                found = met.groupBy("k").agg(F.min(F.struct("d2", "o")).alias("s")).select("k", F.col("s.o").alias("o"), F.col("s.d2").alias("d2"))
            last = size > span
            found = keep(found if last else found.filter(F.col("d2") <= size * size))
            done = found if done is None else done.unionByName(found)
            left_over = keep(left_over.join(found, "k", "left_anti"))
            if last or not left_over.limit(1).count():
                break
            size *= 4
    out = left.select("k")
    out = out.join(done, "k", "left") if done is not None else out.withColumn("o", F.lit(None).cast(right.schema["o"].dataType)).withColumn("d2", F.lit(None).cast("double"))
    return out.select(F.col("k").alias(key), F.col("o").alias(other_key), "d2")


def first_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in the given order; null keys form one group.  Partial minima meet, not sorted groups."""
    rest = [c for c in df.columns if c not in order]
    best = df.groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(*order, *rest)).alias("r"))
    return best.select(*(F.col("r").getField(c).alias(c) for c in df.columns))


def suffixed(left: DataFrame, right: DataFrame, key: str, suffix: str, how: str = "inner") -> DataFrame:
    """An equi-join whose clashing right columns get a suffix."""
    clash = set(left.columns) & set(right.columns) - {key}
    return left.join(right.select(*(F.col(c).alias(c + suffix if c in clash else c) for c in right.columns)), key, how)
