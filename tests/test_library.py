import math
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tessella.functions import geo, raster, vectors
from tessella.operators import dataset, dissolve, joins, metrics, ordered, sampling
from tessella.operators.graph import components
from tessella.schemas import require_columns
from tessella.sources import paths, tables
from tessella.streaming.labels import label_state

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 100


@pytest.mark.parametrize("name", ["nearest_join", "roc_auc", "dedup_priority", "polygon_area", "hsv", "knn_exclude_pos"])
def test_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("embeddings", "customer", "supplier", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df, found = driver.queries()[name](spark, DATA), con.execute(driver.oracle_sql()[name])
    names = [d[0] for d in found.description]
    clean = lambda r: tuple(round(v, 5) if isinstance(v, float) else v for v in r)
    assert sorted(map(clean, df.select(*names).collect()), key=str) == sorted(map(clean, found.fetchall()), key=str)


def test_utm_known_answer(spark):
    df = geo.projected(spark.createDataFrame([(-79.387139, 43.642567)], "lon double, lat double"))
    r = df.first()
    assert (r.utm_zone, r.utm_epsg) == (17, "EPSG:32617")
    assert r.x == pytest.approx(630084.301, abs=2e-3) and r.y == pytest.approx(4833438.586, abs=2e-3)


def test_zone_borders(spark):
    df = spark.createDataFrame([(180.0, 0.0), (-180.0, -1.0)], "lon double, lat double")
    out = df.select(geo.expr(geo.zone_sql("lon")), geo.expr(geo.wrapped_zone_sql("lon")), geo.expr(geo.epsg_sql("lon", "lat")))
    assert rows(out) == [(1, 1, "EPSG:32701"), (61, 1, "EPSG:32601")]


def test_lasso_excludes_its_edges(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, 0.0, 1.0), (3, 2.0, 2.0), (4, 3.0, 1.0)], "id int, x double, y double")
    assert rows(df.filter(geo.expr(geo.inside_sql("x", "y", ring))).select("id")) == [(1,)]


def test_nearest_equals_brute_force(spark):
    draw = random.Random(1)
    points = [(i, draw.choice("ab"), draw.randint(0, 50) * 1.0, draw.randint(0, 50) * 1.0) for i in range(150)]
    others = [(i, draw.choice("a"), draw.randint(0, 50) ** 2 / 50, draw.randint(0, 50) * 1.0) for i in range(60)]
    left, right = spark.createDataFrame(points, "id long, z string, x double, y double"), spark.createDataFrame(others, "oid long, z string, x double, y double")
    gap = lambda p, o: (p[2] - o[2]) ** 2 + (p[3] - o[3]) ** 2
    one, all_ = [], []
    for p in points:
        near = sorted((gap(p, o), o[0]) for o in others if o[1] == p[1])
        one.append((p[0], near[0][1] if near else None))
        all_ += [(p[0], o) for d, o in near if d == near[0][0]] or [(p[0], None)]
    assert rows(joins.nearest(left, right, "id", "oid", by="z").select("id", "oid")) == sorted(one, key=str)
    assert rows(joins.nearest(left, right, "id", "oid", by="z", ties=True).select("id", "oid")) == sorted(all_, key=str)
    assert {r["oid"] for r in joins.nearest(left, right.limit(0), "id", "oid", by="z").collect()} == {None}


def test_within_anti_keeps_none_within(spark):
    draw = random.Random(2)
    points, others = [[(i, "z", draw.uniform(-9, 9), draw.uniform(-9, 9)) for i in range(n)] for n in (120, 15)]
    schema = "id long, z string, x double, y double"
    kept = {r["id"] for r in joins.within_anti(spark.createDataFrame(points, schema), spark.createDataFrame(others, schema), 2.0, zone="z").collect()}
    assert kept == {p[0] for p in points if all((p[2] - o[2]) ** 2 + (p[3] - o[3]) ** 2 > 4 for o in others)}


def test_priority_and_null_keys(spark):
    a = dataset.labelled(spark.createDataFrame([("t1", 1), ("t2", 2), (None, 3)], "tile_id string, seq long"), 0, "ei_neg")
    b = dataset.labelled(spark.createDataFrame([("t2", 1), ("t3", 2), (None, 1)], "tile_id string, seq long"), 1, "ei_pos")
    out = dataset.deduplicated(dataset.union(a, b)).select("tile_id", "label")
    assert rows(out) == [("t1", 0), ("t2", 0), ("t3", 1), (None, 0)]
    with pytest.raises(ValueError):
        require_columns(a, "nothing")


def test_stratified(spark):
    df = spark.createDataFrame([(i, "a" if i % 5 else "b") for i in range(100)], "id long, c string")
    got = {r["c"]: r["count"] for r in sampling.stratified_sample(df, "c", "id", {"a": 7, "b": 1000, "x": 3}).groupBy("c").count().collect()}
    assert got == {"a": 7, "b": 20}
    split = sampling.stratified_split(df, "c", "id")
    assert rows(split.groupBy("c", "split").count()) == [("a", "test", 20), ("a", "train", 60), ("b", "test", 5), ("b", "train", 15)]


def test_running_sums(spark):
    values = [(i, random.Random(i).randint(0, 9)) for i in range(200)]
    out = ordered.running(spark.createDataFrame(values, "k long, v long"), [F.col("k")], {"s": F.col("v")})
    assert rows(out.select("k", "s")) == sorted(((k, sum(v for j, v in values if j <= k)) for k, _ in values), key=str)


def test_metrics(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (0, 0.8, 1), (1, 0.8, 1), (0, 0.1, 0), (1, 0.1, 0)], "y int, score double, pred int")
    assert metrics.auc(df).first()[0] == pytest.approx((0.5 * (1 / 3 + 2 / 3) + 0.5 * (2 / 3 + 1)) / 2)
    assert metrics.accuracy(df).first()[0] == pytest.approx(0.6)
    assert {r["name"] for r in metrics.report(df).collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randint(0, 60), draw.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long")
    real = {n for a, b in edges for n in (a, b) if a != b}
    assert rows(components(df)) == sorted(((n, find(n)) for n in real), key=str)
    assert rows(components(df.limit(0))) == []


def test_dissolve(spark):
    ring = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    cells = spark.createDataFrame([*ring, (3, 3), (-5, -5)], "cx long, cy long")
    parts = dissolve.dissolved(cells)
    assert sorted(r["count"] for r in parts.groupBy("component").count().collect()) == [1, 1, 8]
    found = dissolve.rings(parts).collect()
    assert sorted((len(r["xs"]), r["hole"]) for r in found) == [(4, False), (4, False), (4, True), (12, False)]
    area = {r["n_cells"]: r["area"] for r in dissolve.areas(parts, 0.01, 0.0, 10.0).collect()}
    side = 111.32e3 * 0.01
    assert area[8] == pytest.approx(8 * side * side * math.cos(math.radians(10)), rel=0.02)


def test_label_state(spark):
    log = spark.createDataFrame([(1, 7, 1), (2, 7, 0), (3, 8, 1), (4, 8, -100), (5, 9, 1), (6, 9, 2)], "seq long, tile_idx long, action int")
    assert rows(label_state(log, "seq")) == [(7, 0), (9, 1)]


def test_label_state_streams(spark, tmp_path):
    log = spark.createDataFrame([(1, 7, 1), (2, 7, 0), (3, 8, 1)], "seq long, tile_idx long, action int")
    log.write.parquet(str(tmp_path / "log"))
    stream = label_state(spark.readStream.schema(log.schema).parquet(str(tmp_path / "log")), "seq")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("labels").option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    assert rows(spark.table("labels")) == [(7, 0), (8, 1)]


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, -2.0)], "tile_id string, lon double, lat double")
    wkb = df.select("tile_id", tables.encode_points(F.col("lon"), F.col("lat")).alias("geometry")).unionByName(spark.createDataFrame([("n", None)], "tile_id string, geometry binary"))
    assert rows(tables.decode_points(wkb)) == [("a", 1.5, -2.0), ("n", None, None)]
    assert rows(tables.from_features(df.select(tables.to_features().alias("value")))) == [(1.5, -2.0)]
    (tmp_path / "aoi.geojson").write_text('{"features": [{"geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}}]}')
    assert tables.polygon(spark, str(tmp_path / "aoi.geojson")) == [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    df.select("tile_id").write.parquet(str(tmp_path / "tiles" / "tiles_17_17PLL.parquet"))
    assert rows(tables.lookup(spark, df, [], "tile_id")) == [] and rows(tables.lookup(spark, df, ["a"], "tile_id").select("tile_id")) == [("a",)]
    assert paths.postprocessed("o", "x/p.parquet", 0.9) == "o/p_prob_0.9_postprocess.parquet"


def test_vectors_and_raster(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(vectors.angular("a", "b")).collect()] == [pytest.approx(math.sqrt(2)), None]
    assert [r[0] for r in df.limit(1).select(vectors.query("a", F.lit(None).cast("array<double>"))).collect()] == [[2.0, 0.0]]
    rgb = spark.createDataFrame([(0.0, 0.0, 0.0), (0.0, 1.0, 0.0)], "r double, g double, b double")
    h, s, v = raster.hsv(F.col("r"), F.col("g"), F.col("b"))
    assert [tuple(x) for x in rgb.select(h, s, v).collect()] == [(0.0, 0.0, 0.0), (pytest.approx(1 / 3), 1.0, 1.0)]


def test_settings_and_time_stamped_names(spark, tmp_path):
    from datetime import datetime

    (tmp_path / "ui.json").write_text('{"mgrs_ids": ["16PHC", "17PKT"],\n "index_dim": 384, "imagery": {"basemap": "x"}}')
    assert tables.config(spark, str(tmp_path / "ui.json")) == {"imagery": {"basemap": "x"}, "index_dim": 384, "mgrs_ids": ["16PHC", "17PKT"]}
    assert paths.exported("o", "POS", datetime(2024, 3, 5, 7, 8, 9)) == "o/pos_20240305_070809.geojson"
