"""Per-pixel composites over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import raster
from ..sources.tables import read
from .inputs import PIXELS, Plans, pixels

PLANS = Plans()
add = PLANS.add
START, END = "2024-01-05", "2024-01-20"
_RANGE = f"ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END}'"
_MEDIAN = f"SELECT pixel_id, band, median(CASE WHEN clear_score >= 0.8 THEN value END) / 10000e0 AS value FROM ({PIXELS}) WHERE {_RANGE} GROUP BY pixel_id, band"
_BANDS = f"SELECT pixel_id, max(value) FILTER (WHERE band = 'view') AS r, max(value) FILTER (WHERE band = 'click') AS g, max(value) FILTER (WHERE band = 'purchase') AS b FROM (SELECT pixel_id, band, median(value) / 10000e0 AS value FROM ({PIXELS}) GROUP BY pixel_id, band) GROUP BY pixel_id"


@add(f"SELECT event_id FROM events WHERE {_RANGE}")
def date_range(spark, sf_dir):
    return raster.date_range(read(spark, sf_dir, "events"), START, END).select("event_id")


@add(f"SELECT event_id, CASE WHEN clear_score >= 0.8 THEN value END AS value FROM ({PIXELS})")
def cloud_mask(spark, sf_dir):
    return raster.cloud_masked(pixels(spark, sf_dir)).select("event_id", "value")


@add(f"SELECT pixel_id, band, round(value, 8) AS value FROM ({_MEDIAN})")
def median_composite(spark, sf_dir):
    return raster.median_composite(raster.cloud_masked(raster.date_range(pixels(spark, sf_dir), START, END)), 10000.0).withColumn("value", F.round("value", 8))


def _rgb(spark, sf_dir):
    flat = raster.bands(raster.median_composite(pixels(spark, sf_dir), 10000.0), ["view", "click", "purchase"])
    return flat.dropna().select("pixel_id", F.col("view").alias("r"), F.col("click").alias("g"), F.col("purchase").alias("b"))


@add(f"""SELECT pixel_id, round(CASE WHEN v = m THEN 0 WHEN v = r THEN (CASE WHEN g < b THEN 6 + (g - b) / (v - m) ELSE (g - b) / (v - m) END) WHEN v = g THEN (b - r) / (v - m) + 2 ELSE (r - g) / (v - m) + 4 END / 6, 6) AS h,
round(CASE WHEN v = 0 THEN 0 ELSE (v - m) / v END, 6) AS s, round(v, 8) AS v FROM (SELECT *, greatest(r, g, b) AS v, least(r, g, b) AS m FROM ({_BANDS}) WHERE r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL)""")
def hsv(spark, sf_dir):
    h, s, v = raster.hsv(F.col("r"), F.col("g"), F.col("b"))
    return _rgb(spark, sf_dir).select("pixel_id", F.round(h, 6).alias("h"), F.round(s, 6).alias("s"), F.round(v, 8).alias("v"))


@add(f"SELECT pixel_id, round((r - g) / nullif(r + g, 0), 6) AS ndvi FROM ({_BANDS}) WHERE r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL")
def ndvi(spark, sf_dir):
    return _rgb(spark, sf_dir).select("pixel_id", F.round(raster.normalized_difference(F.col("r"), F.col("g")), 6).alias("ndvi"))


@add(f"SELECT pixel_id, band, value FROM (SELECT *, row_number() OVER (PARTITION BY pixel_id, band ORDER BY ts DESC, scene_id DESC) AS n FROM ({PIXELS}) WHERE clear_score >= 0.8) WHERE n = 1")
def raster_mosaic(spark, sf_dir):
    return raster.mosaic(raster.cloud_masked(pixels(spark, sf_dir)))


@add("SELECT p_partkey, CASE p_size WHEN 10 THEN 1 WHEN 20 THEN 1 WHEN 30 THEN 2 WHEN 40 THEN 3 END AS remapped FROM part WHERE p_size IN (10, 20, 30, 40)")
def raster_remap(spark, sf_dir):
    code = raster.remap(F.col("p_size"), [10, 20, 30, 40], [1, 1, 2, 3])
    return read(spark, sf_dir, "part").select("p_partkey", code.alias("remapped")).filter("remapped is not null")
