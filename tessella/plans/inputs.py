"""The driver's tables in the roles of the pipelines' inputs, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.scratch import keep
from ..sources.tables import read

#: Tiles take other keys than sample points, so that they lie elsewhere.
OFFSET = 100003
LON = "(-88e0 + (({k}) * 7919 % 9973) / 9973e0 * 10e0)"
LAT = "(-4e0 + (({k}) * 104729 % 9967) / 9967e0 * 14e0)"


class Plans:
    """A registry of queries."""

    def __init__(self) -> None:
        self.queries: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

    def add(self, sql: str | None = None):
        def put(f: Callable[[SparkSession, str], DataFrame]):
            self.queries[f.__name__] = (f, sql)
            return f

        return put


def lonlat(key: str) -> tuple[str, str]:
    return LON.format(k=key), LAT.format(k=key)


def points_sql(table: str, key: str, name: str) -> str:
    lon, lat = lonlat(key if table != "embeddings" else f"{key} + {OFFSET}")
    return f"SELECT {key} AS {name}, {lon} AS lon, {lat} AS lat FROM {table}"


def projected_sql(table: str, key: str, name: str) -> str:
    """Points with zone, code, easting and northing."""
    east, north = geo.forward_sql("lon", "lat", "utm_zone")
    code = geo.epsg_sql("lon", "lat", "utm_zone").replace("{string}", "VARCHAR")
    return f"SELECT *, {code} AS utm_epsg, {east} AS x, {north} AS y FROM (SELECT *, {geo.wrapped_zone_sql('lon')} AS utm_zone FROM ({points_sql(table, key, name)}))"


def points(spark: SparkSession, sf_dir: str, table: str, key: str, name: str) -> DataFrame:
    lon, lat = lonlat(key if table != "embeddings" else f"{key} + {OFFSET}")
    return read(spark, sf_dir, table).select(F.col(key).alias(name), F.expr(lon).alias("lon"), F.expr(lat).alias("lat"))


def projected(spark: SparkSession, sf_dir: str, table: str, key: str, name: str) -> DataFrame:
    """Materialised, so that joins compare stored coordinates."""
    return keep(geo.projected(points(spark, sf_dir, table, key, name)))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings")


#: Scored rows: y is whether the label is below 3, the score a rounded component.
SCORED = "SELECT vec_id, CASE WHEN label < 3 THEN 1 ELSE 0 END AS y, round(CAST(embedding[{i}] AS DOUBLE), 2) AS score FROM embeddings"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings(spark, sf_dir).select("vec_id", (F.col("label") < 3).cast("int").alias("y"), F.round(F.col("embedding")[0].cast("double"), 2).alias("score"))


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).withColumn("pred", (F.col("score") > 0.05).cast("int"))


PREDICTED = f"SELECT *, CASE WHEN score > 0.05 THEN 1 ELSE 0 END AS pred FROM ({SCORED.format(i=1)})"

#: Events in the role of pixels.
PIXELS = "SELECT event_id, event_id AS scene_id, ts, user_id AS pixel_id, event_type AS band, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100e0 AS clear_score FROM events"


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("scene_id"), "ts", F.col("user_id").alias("pixel_id"), F.col("event_type").alias("band"), "value", (F.get_json_object("props", "$.k").cast("double") / 100).alias("clear_score"))
