"""Shapes of the tables that the pipelines exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TILES = T.StructType([T.StructField("tile_idx", T.LongType()), T.StructField("tile_id", T.StringType()), T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
EMBEDDINGS = T.StructType([T.StructField("tile_id", T.StringType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
LABELS = T.StructType([T.StructField("tile_id", T.StringType()), T.StructField("label", T.IntegerType()), T.StructField("class", T.StringType())])
LABEL_EVENTS = T.StructType([T.StructField("seq", T.LongType()), T.StructField("tile_idx", T.LongType()), T.StructField("action", T.IntegerType())])
PREDICTIONS = T.StructType([T.StructField("tile_id", T.StringType()), T.StructField("prediction_probability", T.DoubleType())])
PIXELS = T.StructType(
    [T.StructField("scene_id", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("pixel_id", T.LongType()), T.StructField("band", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("clear_score", T.DoubleType())]
)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """The frame itself, or an error that names what is missing."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
