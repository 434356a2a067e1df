"""Per-pixel algebra over long pixel tables (scene_id, ts, pixel_id, band, value, clear_score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cloud_masked(pixels: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Values of pixels that are clear enough, inclusive; others, and those without a score, become null."""
    return pixels.withColumn("value", F.when(F.col("clear_score") >= threshold, F.col("value")))


def date_range(df: DataFrame, start: str, end: str, ts: str = "ts") -> DataFrame:
    """From start, inclusive, to end, exclusive."""
    return df.filter((F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp")))


def median_composite(pixels: DataFrame, scale: float = 1.0) -> DataFrame:
    """Median over time of each pixel and band, divided by scale."""
    return pixels.groupBy("pixel_id", "band").agg((F.median("value") / scale).alias("value"))


def mosaic(pixels: DataFrame) -> DataFrame:
    """The last unmasked value of each pixel and band, later scenes winning ties."""
    return pixels.filter("value is not null").groupBy("pixel_id", "band").agg(F.max_by("value", F.struct("ts", "scene_id")).alias("value"))


def bands(pixels: DataFrame, names: list[str]) -> DataFrame:
    """One row per pixel with a column for each of the named bands."""
    return pixels.filter(F.col("band").isin(*names)).groupBy("pixel_id").agg(*(F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in names))


def linked(pixels: DataFrame, scores: DataFrame) -> DataFrame:
    """Pixels with the clear score of their scene; scenes without one stay, unscored."""
    return pixels.drop("clear_score").join(scores.select("scene_id", "clear_score"), "scene_id", "left")


def hsv(red: Column, green: Column, blue: Column) -> tuple[Column, Column, Column]:
    """Hue, saturation and value, each from 0 to 1."""
    most, least = F.greatest(red, green, blue), F.least(red, green, blue)
    spread = most - least
    hue = F.when(spread == 0, 0.0).when(most == red, F.pmod((green - blue) / spread, F.lit(6.0))).when(most == green, (blue - red) / spread + 2).otherwise((red - green) / spread + 4) / 6
    return hue, F.when(most == 0, 0.0).otherwise(spread / most), most


def normalized_difference(a: Column, b: Column) -> Column:
    return (a - b) / F.nullif(a + b, F.lit(0.0))


def remap(code: Column, inputs: list, outputs: list) -> Column:
    """Codes replaced pairwise; one that is not listed is masked."""
    if len(inputs) != len(outputs):
        raise ValueError("inputs and outputs differ in length")
    out = F.lit(None)
    for a, b in zip(inputs[::-1], outputs[::-1], strict=True):
        out = F.when(code == a, F.lit(b)).otherwise(out)
    return out
