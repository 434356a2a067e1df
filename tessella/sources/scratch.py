"""Reliable intermediate results in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark deletes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the cluster names it.

    Only a local master, whose executors are threads of the driver, may do without; any other raises.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tessella-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """What is planned and run inside leaves no shuffle files behind; the session's setting is as before afterwards."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored(df: DataFrame, name: str = "kept") -> DataFrame:
    """Cut the lineage at a Parquet table in the shared folder: a lost executor costs no recomputation, plans stay small.

    The table goes with the session, or before by `forget`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tessella/{name}-{uuid.uuid4().hex}"
    with released(spark):
        df.write.parquet(path)
    at, files = _path(spark, path)
    files.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


#: Cut the lineage of a result without a name of its own.
keep = stored


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again: every DataFrame that reads them has been written or collected."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            at, files = _path(df.sparkSession, file)
            files.delete(at.getParent(), True)
