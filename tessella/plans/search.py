"""Scans, projections, lookups, joins, and the similarity search."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import raster, vectors
from ..operators import joins
from ..operators import search as ops
from ..sources import tables
from ..sources.scratch import keep, shared_dir
from ..sources.tables import read
from .inputs import Plans, embeddings, points, points_sql

PLANS = Plans()
add = PLANS.add
DIM = 64


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings(spark, sf_dir).filter("label < 2").select(F.col("vec_id").alias("tile_idx"), F.when(F.col("label") == 0, 1).otherwise(0).alias("label"))


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings(spark, sf_dir).select(F.col("vec_id").alias("tile_idx"), "embedding")


@add(points_sql("embeddings", "vec_id", "tile_idx").replace("AS lon", "AS lon_").replace("AS lat", "AS lat_").join(["SELECT tile_idx, round(lon_, 6) AS lon, round(lat_, 6) AS lat FROM (", ")"]))
def scan_tiles(spark, sf_dir):
    p = points(spark, sf_dir, "embeddings", "vec_id", "tile_idx")
    wkb = p.select("tile_idx", tables.encode_points(F.col("lon"), F.col("lat")).alias("geometry"))
    return tables.decode_points(wkb).select("tile_idx", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@add("SELECT vec_id, label, len(embedding) AS dim, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 5) AS total FROM embeddings")
def scan_embeddings(spark, sf_dir):
    return embeddings(spark, sf_dir).select("vec_id", "label", F.size("embedding").cast("long").alias("dim"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("total"))


@add(f"SELECT vec_id, {', '.join(f'round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS vit_{i}' for i in range(DIM))} FROM embeddings")
def wide_vector(spark, sf_dir):
    wide = tables.to_wide(embeddings(spark, sf_dir).select("vec_id", "embedding"), DIM)
    back = tables.to_array(wide)
    return back.select("vec_id", *(F.round(F.col("embedding")[i], 6).alias(f"vit_{i}") for i in range(DIM)))


@add("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def project_cols(spark, sf_dir):
    return read(spark, sf_dir, "orders").drop("o_totalprice", "o_orderdate", "o_orderpriority", "not_there").select("o_orderkey", "o_custkey", "o_orderstatus")


@add("SELECT c_custkey AS tile_id, c_name FROM customer")
def rename_col(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", "c_name").withColumnRenamed("c_custkey", "tile_id").withColumnRenamed("not_there", "x")


@add("SELECT vec_id, label FROM embeddings WHERE label = 1")
def eq_filter(spark, sf_dir):
    return embeddings(spark, sf_dir).filter(F.col("label") == 1).select("vec_id", "label")


@add("SELECT count(*) AS n, count(*) FILTER (WHERE label = 0) AS n_neg FROM embeddings")
def counts(spark, sf_dir):
    return embeddings(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if(F.col("label") == 0).alias("n_neg"))


@add("SELECT DISTINCT o_custkey AS tile_id FROM orders WHERE o_custkey IS NOT NULL")
def distinct_ids(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("tile_id")).dropna().distinct()


@add("SELECT vec_id, label FROM embeddings WHERE vec_id IN (3, 17, 42, 99, 250, 499, 100000000)")
def in_list_lookup(spark, sf_dir):
    return tables.lookup(spark, embeddings(spark, sf_dir).select("vec_id", "label"), [3, 17, 42, 99, 250, 499, 100000000], "vec_id")


@add("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_join(spark, sf_dir):
    wanted = read(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(wanted, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@add("SELECT i.rank, e.vec_id, e.label FROM (VALUES (0, 42), (1, 7), (2, 300), (3, 0)) AS i(rank, id) JOIN embeddings e ON e.vec_id = i.id")
def index_lookup(spark, sf_dir):
    ids = spark.createDataFrame(list(enumerate([42, 7, 300, 0])), "rank int, vec_id long")
    return embeddings(spark, sf_dir).select("vec_id", "label").join(ids, "vec_id").orderBy("rank").select("rank", "vec_id", "label")


@add("SELECT tile_idx, label FROM (SELECT vec_id AS tile_idx, 1 AS label FROM embeddings WHERE label = 0 UNION ALL SELECT vec_id, 0 FROM embeddings WHERE label = 1)")
def reload_labels(spark, sf_dir):
    tiles, saved = _tiles(spark, sf_dir).select("tile_idx"), _labels(spark, sf_dir)
    parts = [tiles.join(saved.filter(F.col("label") == v), "tile_idx", "left_semi").withColumn("label", F.lit(v)) for v in (1, 0)]
    return parts[0].unionByName(parts[1])


@add("SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def anti_join_train(spark, sf_dir):
    trained = read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("vec_id"))
    return embeddings(spark, sf_dir).select("vec_id", "label").join(trained, "vec_id", "left_anti")


@add(f"SELECT c.id FROM ({points_sql('customer', 'c_custkey', 'id')}) c WHERE NOT EXISTS (SELECT 1 FROM ({points_sql('supplier', 's_suppkey', 'id')}) s WHERE s.lon = c.lon AND s.lat = c.lat)")
def exact_geom_anti(spark, sf_dir):
    c, s = points(spark, sf_dir, "customer", "c_custkey", "id"), points(spark, sf_dir, "supplier", "s_suppkey", "id")
    return c.join(s.select("lon", "lat"), ["lon", "lat"], "left_anti").select("id")


@add("SELECT e.vec_id AS tile_id, round(CAST(e.embedding[1] AS DOUBLE), 6) AS first, l.c_mktsegment AS class FROM embeddings e JOIN customer l ON l.c_custkey = e.vec_id")
def inner_join_embeddings(spark, sf_dir):
    labels = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("tile_id"), F.col("c_mktsegment").alias("class"))
    e = embeddings(spark, sf_dir).select(F.col("vec_id").alias("tile_id"), F.round(F.col("embedding")[0].cast("double"), 6).alias("first"))
    return e.join(labels, "tile_id")


@add("SELECT l.l_orderkey AS tile_id, l.l_partkey AS k, o.o_custkey AS k_tile, l.l_linenumber AS line FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey")
def inner_join_suffix(spark, sf_dir):
    left = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tile_id"), F.col("l_partkey").alias("k"), F.col("l_linenumber").alias("line"))
    right = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tile_id"), F.col("o_custkey").alias("k"))
    return joins.suffixed(left, right, "tile_id", "_tile").select("tile_id", "k", "k_tile", "line")


@add("SELECT o.o_orderkey, c.c_name FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey")
def left_join_centroids(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left").select("o_orderkey", "c_name")


@add("SELECT e.event_id, CAST(json_extract_string(s.props, '$.k') AS DOUBLE) / 100e0 AS clear_score FROM events e LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') s ON s.event_id = e.event_id")
def link_collection(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    scores = e.filter("event_type = 'view'").select(F.col("event_id").alias("scene_id"), (F.get_json_object("props", "$.k").cast("double") / 100).alias("clear_score"))
    return raster.linked(e.select(F.col("event_id").alias("scene_id")), scores).select(F.col("scene_id").alias("event_id"), "clear_score")


@add("SELECT p_partkey, CASE p_size WHEN 1 THEN 'water' WHEN 2 THEN 'trees' WHEN 5 THEN 'crops' WHEN 7 THEN 'built' END AS class FROM part")
def class_map(spark, sf_dir):
    names = {"1": "water", "2": "trees", "5": "crops", "7": "built"}
    lookup = F.create_map(*(x for k, v in names.items() for x in (F.lit(int(k)), F.lit(v))))
    return read(spark, sf_dir, "part").select("p_partkey", F.try_element_at(lookup, F.col("p_size")).alias("class"))


@add("SELECT pos, round(avg(x), 6) AS mean FROM (SELECT unnest(range(64)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings WHERE label = 0) GROUP BY pos")
def mean_vector(spark, sf_dir):
    m = vectors.mean(embeddings(spark, sf_dir).filter("label = 0"))
    return m.select(F.posexplode("mean").alias("pos", "mean")).select(F.col("pos").cast("long"), F.round("mean", 6).alias("mean"))


_QUERY = "SELECT pos, 2 * avg(x) FILTER (WHERE label = 0) - avg(x) FILTER (WHERE label = 1) AS q FROM (SELECT label, unnest(range(64)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings WHERE label < 2) GROUP BY pos"


@add(f"SELECT pos, round(q, 6) AS q FROM ({_QUERY})")
def query_vector(spark, sf_dir):
    q = ops.query_vector(_tiles(spark, sf_dir), _labels(spark, sf_dir))
    return q.select(F.posexplode("q").alias("pos", "q")).select(F.col("pos").cast("long"), F.round("q", 6).alias("q"))


_NEAR = f"""WITH q AS ({_QUERY}), parts AS (SELECT vec_id, unnest(range(64)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
near AS (SELECT vec_id AS tile_idx, sqrt(greatest(0, 2 - 2 * sum(x * q) / (sqrt(sum(x * x)) * sqrt(sum(q * q))))) AS distance FROM parts JOIN q ON q.pos = parts.pos GROUP BY vec_id),
top AS (SELECT tile_idx, round(distance, 6) AS distance FROM near ORDER BY near.distance, tile_idx LIMIT 100)"""


def _top(spark, sf_dir):
    tiles = _tiles(spark, sf_dir)
    return ops.nearest(tiles, ops.query_vector(tiles, _labels(spark, sf_dir)), 100)


@add(f"{_NEAR} SELECT tile_idx, distance FROM top")
def knn_angular(spark, sf_dir):
    return _top(spark, sf_dir).select("tile_idx", F.round("distance", 6).alias("distance"))


@add(f"{_NEAR} SELECT tile_idx, distance FROM top WHERE tile_idx NOT IN (SELECT vec_id FROM embeddings WHERE label = 0)")
def knn_exclude_pos(spark, sf_dir):
    return ops.excluding(_top(spark, sf_dir), _labels(spark, sf_dir).filter("label = 1")).select("tile_idx", F.round("distance", 6).alias("distance"))


@add()
def knn_lsh(spark, sf_dir):
    tiles = _tiles(spark, sf_dir)
    q = ops.query_vector(tiles, _labels(spark, sf_dir)).first()["q"]  # one vector
    return ops.approximate(tiles, q, 100)


@add("SELECT s_suppkey AS id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM (" + points_sql("supplier", "s_suppkey", "s_suppkey") + ")")
def geojson_roundtrip(spark, sf_dir):
    p = points(spark, sf_dir, "supplier", "s_suppkey", "id")
    path = f"{shared_dir(spark)}/tessella/geojson-{uuid.uuid4().hex}"
    p.select(tables.to_features(key="id").alias("value")).write.text(path)
    feature = F.from_json("value", tables.FEATURE.replace("type:string,", "type:string,id:long,", 1))
    rows = spark.read.text(path).select(feature.alias("f")).select("f.id", F.col("f.geometry.coordinates").alias("at"))
    return rows.select("id", F.round(F.col("at")[0], 6).alias("lon"), F.round(F.col("at")[1], 6).alias("lat"))


@add("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_roundtrip(spark, sf_dir):
    path = f"{shared_dir(spark)}/tessella/sink-{uuid.uuid4().hex}"
    read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
