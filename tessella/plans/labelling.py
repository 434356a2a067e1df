"""Labels, sampling, and the assembly of the training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dataset, sampling
from ..sources import tables
from ..sources.tables import read
from ..streaming.labels import label_state as state
from .inputs import Plans, embeddings

PLANS = Plans()
add = PLANS.add
COUNTS = {"view": 50, "click": 20, "purchase": 1000000, "nothing": 5}


@add("SELECT max(tile_idx) AS tile_idx, label FROM (SELECT user_id AS tile_idx, last(CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 0 WHEN 'error' THEN -100 END ORDER BY ts, event_id) AS label FROM events WHERE event_type IN ('purchase', 'view', 'error') GROUP BY user_id) WHERE label <> -100 GROUP BY tile_idx, label")
def label_state(spark, sf_dir):
    action = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "view", 0).when(F.col("event_type") == "error", -100).otherwise(2)
    log = read(spark, sf_dir, "events").select("ts", "event_id", F.col("user_id").alias("tile_idx"), action.alias("action"))
    return state(log, "ts", "event_id")


@add("SELECT vec_id AS tile_id, 1 AS label, 'ei_pos' AS class FROM embeddings WHERE label = 0")
def label_assign(spark, sf_dir):
    return dataset.labelled(embeddings(spark, sf_dir).filter("label = 0").select(F.col("vec_id").alias("tile_id")), 1, "ei_pos")


def _parts(spark, sf_dir):
    e = embeddings(spark, sf_dir).select(F.col("vec_id").alias("tile_id"), F.col("vec_id").alias("seq"), F.col("label").alias("group"))
    lulc = e.filter("group in (2, 3)").select("tile_id", "seq", F.concat(F.lit("lulc_"), F.col("group").cast("string")).alias("class"))
    mined, pos = e.filter("group in (1, 2)").select("tile_id", "seq"), e.filter("group in (0, 1, 3)").select("tile_id", "seq")
    return [dataset.labelled(lulc, 0, "lulc"), dataset.labelled(mined, 0, "ei_neg"), dataset.labelled(pos, 1, "ei_pos")]


_UNION = """SELECT vec_id AS tile_id, vec_id AS seq, 0 AS label, concat('lulc_', CAST(label AS VARCHAR)) AS class, 0 AS src FROM embeddings WHERE label IN (2, 3)
UNION ALL SELECT vec_id, vec_id, 0, 'ei_neg', 1 FROM embeddings WHERE label IN (1, 2) UNION ALL SELECT vec_id, vec_id, 1, 'ei_pos', 2 FROM embeddings WHERE label IN (0, 1, 3)"""
_FIRST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY src, seq) AS r FROM ({_UNION})) WHERE r = 1"


@add("SELECT tile_id, label, extra, src FROM (SELECT vec_id AS tile_id, label, NULL AS extra, 0 AS src FROM embeddings WHERE label = 0 UNION ALL SELECT vec_id, NULL, 'x', 1 FROM embeddings WHERE label = 1)")
def union_by_name(spark, sf_dir):
    e = embeddings(spark, sf_dir).withColumnRenamed("vec_id", "tile_id")
    return dataset.union(e.filter("label = 0").select("tile_id", "label"), e.filter("label = 1").select("tile_id", F.lit("x").alias("extra"))).select("tile_id", "label", "extra", "src")


@add(f"SELECT tile_id, label, class, src FROM ({_FIRST})")
def dedup_priority(spark, sf_dir):
    return dataset.deduplicated(dataset.union(*_parts(spark, sf_dir))).select("tile_id", "label", "class", "src")


@add(f"SELECT tile_id, round(CAST(e.embedding[1] AS DOUBLE), 6) AS first, d.label, class FROM ({_FIRST}) d JOIN embeddings e ON e.vec_id = d.tile_id")
def dataset_build(spark, sf_dir):
    e = embeddings(spark, sf_dir).select(F.col("vec_id").alias("tile_id"), "embedding")
    return dataset.build(_parts(spark, sf_dir), e).select("tile_id", F.round(F.col("embedding")[0].cast("double"), 6).alias("first"), "label", "class")


@add(f"SELECT event_id, event_type FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5(concat('0:', CAST(event_id AS VARCHAR))), event_id) AS r FROM events) WHERE r <= CASE event_type {' '.join(f'WHEN {c!r} THEN {n}' for c, n in COUNTS.items())} ELSE 0 END")
def stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(read(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id", COUNTS)


@add("SELECT vec_id, label, CASE WHEN r <= round(0.25 * n) THEN 'test' ELSE 'train' END AS split FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42:', CAST(vec_id AS VARCHAR))), vec_id) AS r, count(*) OVER (PARTITION BY label) AS n FROM embeddings)")
def stratified_split(spark, sf_dir):
    return sampling.stratified_split(embeddings(spark, sf_dir).select("vec_id", "label"), "label", "vec_id")


@add("SELECT vec_id, CASE WHEN label < 3 THEN 5e0 ELSE 1e0 END AS weight FROM embeddings")
def sample_weight(spark, sf_dir):
    return embeddings(spark, sf_dir).withColumn("y", (F.col("label") < 3).cast("int")).select("vec_id", sampling.sample_weight("y", 5).alias("weight"))


@add("SELECT p_partkey, substr(p_name, 1, 5) AS mgrs FROM part")
def mgrs_prefix(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.substring("p_name", 1, 5).alias("mgrs"))


@add("SELECT c_custkey, split_part(concat('a/b/tiles_', c_mktsegment, '_x.parquet'), '_', 2) AS zone FROM customer")
def filename_token(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", tables.token(F.concat(F.lit("a/b/tiles_"), F.col("c_mktsegment"), F.lit("_x.parquet")), 1).alias("zone"))


@add("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_returnflag")
def partition_prune(spark, sf_dir):
    import uuid

    from ..sources.scratch import shared_dir

    path = f"{shared_dir(spark)}/tessella/parts-{uuid.uuid4().hex}"
    read(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag").write.partitionBy("l_returnflag").parquet(path)
    return spark.read.parquet(path).filter("l_returnflag = 'R'").groupBy("l_returnflag").agg(F.count("*").alias("n"))
