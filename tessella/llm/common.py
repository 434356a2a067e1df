"""Session helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components as components
from ..sources.scratch import forget as forget
from ..sources.scratch import keep as keep
from ..sources.scratch import released as released
from ..sources.scratch import stored as stored

#: Arrow batches handed to Python hold at most so many bytes, so that a worker's memory does not follow the row width.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for key, value in ARROW_BATCH.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A few rows of the driver as a local relation.

    From a list of tuples Spark makes an RDD instead, which has no known size and is read through Python workers of its own
    kind on the executors; they stay beside those of the operators.
    """
    return spark.createDataFrame(pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema))


#: Bits of a Bloom bitmap for each value, of which two are set, and the most bits of one: a proven bound of 16 MB on what
#: is sent to the executors.
BLOOM_BITS, MOST_BITS = 128, 27


def bloom(hashes: DataFrame, column: str) -> np.ndarray:
    """A bitmap of a column of uniformly hashed longs, with BLOOM_BITS bits a value while that is within its bound.

    Beyond, more values pass that are not in the column: callers join what passes with the column itself.
    """
    bits = min(MOST_BITS, max(16, (BLOOM_BITS * hashes.count()).bit_length()))
    values = hashes.filter(F.col(column).isNotNull())
    cell = F.col("cell").bitwiseAND(F.lit((1 << bits) - 1))
    with released(hashes.sparkSession):
        words = (
            values.select(F.col(column).alias("cell"))
            .unionAll(values.select(F.shiftrightunsigned(column, 64 - bits).alias("cell")))
            .select(F.shiftright(cell, 6).alias("word"), F.expr("shiftleft(1L, cast(cell & 63 as int))").alias("bit"))
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bits"))
            .toArrow()
        )
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def in_bloom(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    low = hashes.view(np.int64) & (64 * len(bitmap) - 1)
    out = ((bitmap[low >> 6] >> (low & 63)) & 1).astype(bool)
    at = np.flatnonzero(out)
    high = (hashes.view(np.uint64)[at] >> np.uint64(64 - (64 * len(bitmap)).bit_length() + 1)).astype(np.int64)
    out[at] = (bitmap[high >> 6] >> (high & 63)) & 1
    return out


def none_as_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))
