"""Similarity search: labelled tiles to a query vector to the nearest tiles."""

from __future__ import annotations

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors


def query_vector(embeddings: DataFrame, labels: DataFrame, key: str = "tile_idx") -> DataFrame:
    """One row q: twice the mean of the positive embeddings less that of the negative ones."""
    both = embeddings.join(labels.select(key, "label"), key)
    means = vectors.mean(both, "embedding", "label")
    side = lambda label: F.max(F.when(F.col("label") == label, F.col("mean")))
    return means.agg(vectors.query(side(1), side(0)).alias("q"))


def nearest(embeddings: DataFrame, query: DataFrame, k: int, key: str = "tile_idx") -> DataFrame:
    """(key, distance) of the k nearest by angle; equal distances by key.  Each task passes on k rows at most.

    The query is one row, which is broadcast.
    """
    near = embeddings.crossJoin(F.broadcast(query.limit(1))).select(key, vectors.angular("embedding", "q").alias("distance"))
    return near.filter("distance is not null").orderBy("distance", key).limit(k)


def excluding(found: DataFrame, ids: DataFrame, key: str = "tile_idx") -> DataFrame:
    """The found rows that are not in ids; filtered after the top k, so fewer than k may stay."""
    return found.join(ids.select(key), key, "left_anti")


def approximate(embeddings: DataFrame, query: list[float], k: int, key: str = "tile_idx", tables: int = 8, seed: int = 42) -> DataFrame:
    """The k nearest among those that share a hash bucket with the query; unit vectors, so Euclidean order is angular."""
    unit = embeddings.select(key, array_to_vector(F.transform("embedding", lambda x: x.cast("double") / vectors.norm("embedding"))).alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=0.75, numHashTables=tables, seed=seed).fit(unit)
    size = sum(x * x for x in query) ** 0.5 or 1.0
    from pyspark.ml.linalg import Vectors

    return model.approxNearestNeighbors(unit, Vectors.dense([x / size for x in query]), k, distCol="distance").select(key, "distance")
