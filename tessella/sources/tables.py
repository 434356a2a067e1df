"""Scans and sinks: embedding files, tile files by MGRS square, well-known-binary points, GeoJSON."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def features(df: DataFrame, part: str = "vit") -> list[str]:
    """The feature columns of a wide table: those whose name contains `part`."""
    return [c for c in df.columns if part in c]


def to_array(df: DataFrame, part: str = "vit", name: str = "embedding") -> DataFrame:
    """A wide table's feature columns as one array; wide rows of hundreds of columns leave generated code."""
    wide = features(df, part)
    return df.select(*(c for c in df.columns if c not in wide), F.array(*(F.col(c).cast("double") for c in wide)).alias(name))


def to_wide(df: DataFrame, size: int, name: str = "embedding", part: str = "vit") -> DataFrame:
    return df.select(*(c for c in df.columns if c != name), *(F.col(name)[i].cast("double").alias(f"{part}_{i}") for i in range(size)))


def tile_files(spark: SparkSession, tiles_dir: str, mgrs_ids: list[str]) -> DataFrame:
    """Tiles of the squares' files, the first of each by path, with the zone that its name's second token gives."""
    if not mgrs_ids:
        raise ValueError("no MGRS square given")
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(tiles_dir).select("path")
    wanted = spark.createDataFrame([(m,) for m in mgrs_ids], "mgrs_id string")
    first = names.join(wanted, F.element_at(F.split("path", "/"), -1).contains(F.col("mgrs_id"))).groupBy("mgrs_id").agg(F.min("path").alias("path")).collect()
    if not first:
        return spark.createDataFrame([], "tile_id string, zone string")
    return spark.read.parquet(*(r["path"] for r in first)).withColumn("zone", token(F.col("_metadata.file_path"), 1))


def token(path: Column, place: int) -> Column:
    """A `_`-separated token of a path's file name, from 0."""
    return F.split(F.element_at(F.split(path, "/"), -1), "_")[place]


def lookup(spark: SparkSession, table: DataFrame, ids: list[str], key: str = "tile_id") -> DataFrame:
    """Rows of the given ids, which travel as data and not as SQL text; an empty list finds nothing."""
    wanted = spark.createDataFrame([(i,) for i in ids], T.StructType([table.schema[key]]))
    return table.join(wanted.distinct(), key, "left_semi")


def decode_points(df: DataFrame, wkb: str = "geometry") -> DataFrame:
    """Little-endian WKB points as lon and lat; null and other geometries give nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(wkb)).to_pylist()
            good = np.array([v is not None and len(v) == 21 and v[:5] == b"\x01\x01\x00\x00\x00" for v in values], bool)
            xy = np.zeros((len(values), 2))
            if good.any():
                xy[good] = np.frombuffer(b"".join(v[5:] for v, g in zip(values, good, strict=True) if g), "<f8").reshape(-1, 2)
            keep = [i for i, f in enumerate(batch.schema) if f.name != wkb]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(xy[:, 0], mask=~good), pa.array(xy[:, 1], mask=~good)], [*(batch.schema.field(i).name for i in keep), "lon", "lat"])

    schema = T.StructType([f for f in df.schema if f.name != wkb] + [T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
    return df.mapInArrow(run, schema)


def encode_points(lon: Column, lat: Column) -> Column:
    """WKB of points, by arithmetic on the doubles' own bytes in a vectorised function."""

    @F.arrow_udf(T.BinaryType())
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        xy = np.stack([x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)], axis=1).astype("<f8")
        return pa.array([b"\x01\x01\x00\x00\x00" + row.tobytes() for row in xy], pa.binary())

    return run(lon, lat)


def to_features(lon: str = "lon", lat: str = "lat", key: str | None = None) -> Column:
    """A GeoJSON feature of a point, geometry only, as text; `key` names a column that becomes the feature's id."""
    named = [F.col(key).alias("id")] if key else []
    return F.to_json(F.struct(F.lit("Feature").alias("type"), *named, F.create_map().cast("map<string,string>").alias("properties"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry")))


FEATURE = "struct<type:string,geometry:struct<type:string,coordinates:array<double>>>"


def from_features(df: DataFrame, text: str = "value") -> DataFrame:
    """Points of GeoJSON features, one to a row, or of the features of a whole collection."""
    parsed = F.from_json(F.col(text), f"struct<type:string,geometry:struct<type:string,coordinates:array<double>>,features:array<{FEATURE}>>")
    one = df.withColumn("g", parsed).withColumn("f", F.explode(F.coalesce("g.features", F.array(F.struct(F.col("g.type").alias("type"), F.col("g.geometry").alias("geometry"))))))
    return one.select(F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.geometry.coordinates")[1].alias("lat"))


def config(spark: SparkSession, path: str) -> dict:
    """A JSON document of settings, read by Spark so that it may lie in any store that the session reads."""
    return spark.read.option("multiLine", True).json(path).first().asDict(recursive=True)


def polygon(spark: SparkSession, path: str) -> list[tuple[float, float]]:
    """Outer ring of feature 0 of a GeoJSON file; later features and holes are not read."""
    row = spark.read.option("multiLine", True).json(path).select(F.col("features")[0]["geometry"]["coordinates"].alias("c")).first()
    return [(float(x), float(y)) for x, y in row["c"][0]]
