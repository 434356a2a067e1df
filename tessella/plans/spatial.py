"""Zones, projection, nearest and within-distance joins, polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import dissolve, joins
from ..sources.scratch import keep
from .inputs import Plans, embeddings, points, points_sql, projected, projected_sql

PLANS = Plans()
add = PLANS.add

CUSTOMERS, SUPPLIERS, TILES = ("customer", "c_custkey", "id"), ("supplier", "s_suppkey", "sid"), ("embeddings", "vec_id", "tile_idx")
#: A lasso with a notch.
LASSO = [(-86.0, -2.0), (-80.0, -2.0), (-80.0, 8.0), (-83.0, 3.0), (-86.0, 8.0)]
BOX = (-85.0, -1.0, -81.0, 5.0)
RADIUS = 20000.0
#: Grid squares of a hundredth of a degree, placed by the first two embedding components.
CELL, LON0, LAT0 = 0.01, -84.0, 5.0


def _sql(text: str, **more: str) -> str:
    return text.format(c=projected_sql(*CUSTOMERS), s=projected_sql(*SUPPLIERS), t=projected_sql(*TILES), pc=points_sql(*CUSTOMERS), pt=points_sql(*TILES), **more)


@add(_sql("SELECT id, {z} AS utm_zone, CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END AS hemisphere, {e} AS utm_epsg FROM ({pc})", z=geo.zone_sql("lon"), e=geo.epsg_sql("lon", "lat", geo.zone_sql("lon")).replace("{string}", "VARCHAR")))
def utm_zone(spark, sf_dir):
    return points(spark, sf_dir, *CUSTOMERS).select("id", geo.expr(geo.zone_sql("lon")).alias("utm_zone"), F.when(F.col("lat") >= 0, "N").otherwise("S").alias("hemisphere"), geo.expr(geo.epsg_sql("lon", "lat", geo.zone_sql("lon"))).alias("utm_epsg"))


@add(_sql("SELECT id, {z} AS utm_zone FROM ({pc})", z=geo.wrapped_zone_sql("lon")))
def utm_zone_wrapped(spark, sf_dir):
    return points(spark, sf_dir, *CUSTOMERS).select("id", geo.expr(geo.wrapped_zone_sql("lon")).alias("utm_zone"))


@add(_sql("SELECT id, utm_epsg, round(x, 3) AS x, round(y, 3) AS y FROM ({c})"))
def utm_project(spark, sf_dir):
    return geo.projected(points(spark, sf_dir, *CUSTOMERS)).select("id", "utm_epsg", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@add(_sql("SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM ({pc})"))
def utm_roundtrip(spark, sf_dir):
    p = projected(spark, sf_dir, *CUSTOMERS)
    lon, lat = geo.inverse_sql("x", "y", "utm_zone", "lat < 0e0")
    return p.select("id", F.round(geo.expr(lon), 6).alias("lon"), F.round(geo.expr(lat), 6).alias("lat"))


@add(_sql("SELECT utm_epsg FROM ({c}) ORDER BY id LIMIT 1"))
def first_point_zone(spark, sf_dir):
    return geo.projected(points(spark, sf_dir, *CUSTOMERS)).orderBy("id").limit(1).select("utm_epsg")


@add(_sql("SELECT round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat FROM (SELECT DISTINCT lon, lat FROM ({pc}))"))
def map_center(spark, sf_dir):
    return points(spark, sf_dir, *CUSTOMERS).select("lon", "lat").distinct().agg(F.round(F.avg("lon"), 6).alias("lon"), F.round(F.avg("lat"), 6).alias("lat"))


@add(_sql(f"SELECT id FROM ({{pc}}) WHERE lon BETWEEN {BOX[0]} AND {BOX[2]} AND lat BETWEEN {BOX[1]} AND {BOX[3]}"))
def bbox_filter(spark, sf_dir):
    return points(spark, sf_dir, *CUSTOMERS).filter(F.col("lon").between(BOX[0], BOX[2]) & F.col("lat").between(BOX[1], BOX[3])).select("id")


_PAIRS = "SELECT c.id, t.tile_idx, (c.x - t.x) * (c.x - t.x) + (c.y - t.y) * (c.y - t.y) AS d2 FROM ({c}) c LEFT JOIN ({t}) t ON t.utm_epsg = c.utm_epsg"


@add(_sql(f"SELECT id, tile_idx, round(sqrt(d2), 2) AS metres FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, tile_idx) AS r FROM ({_PAIRS})) WHERE r = 1"))
def nearest_join(spark, sf_dir):
    out = joins.nearest(projected(spark, sf_dir, *CUSTOMERS), projected(spark, sf_dir, *TILES), "id", "tile_idx")
    return out.select("id", "tile_idx", F.round(F.sqrt("d2"), 2).alias("metres"))


@add(_sql(f"SELECT id, tile_idx, round(sqrt(d2), 2) AS metres FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY d2) AS r FROM ({_PAIRS})) WHERE r = 1"))
def nearest_join_ties(spark, sf_dir):
    out = joins.nearest(projected(spark, sf_dir, *CUSTOMERS), projected(spark, sf_dir, *TILES), "id", "tile_idx", ties=True)
    return out.select("id", "tile_idx", F.round(F.sqrt("d2"), 2).alias("metres"))


@add(_sql("SELECT id, tile_idx FROM (SELECT c.id, t.tile_idx, row_number() OVER (PARTITION BY c.id ORDER BY (c.lon - t.lon) * (c.lon - t.lon) + (c.lat - t.lat) * (c.lat - t.lat), t.tile_idx) AS r FROM ({pc}) c, ({pt}) t) WHERE r = 1"))
def nearest_degrees(spark, sf_dir):
    plane = lambda p: p.withColumnsRenamed({"lon": "x", "lat": "y"})
    return joins.nearest(plane(points(spark, sf_dir, *CUSTOMERS)), plane(points(spark, sf_dir, *TILES)), "id", "tile_idx", by=None).select("id", "tile_idx")


@add(_sql("SELECT tile_idx FROM ({pt}) ORDER BY (lon + 84e0) * (lon + 84e0) + (lat - 1e0) * (lat - 1e0), tile_idx LIMIT 1"))
def nearest_one_point(spark, sf_dir):
    gap = (F.col("lon") + 84) * (F.col("lon") + 84) + (F.col("lat") - 1) * (F.col("lat") - 1)
    return points(spark, sf_dir, *TILES).orderBy(gap, "tile_idx").limit(1).select("tile_idx")


@add(_sql(f"SELECT c.id FROM ({{c}}) c WHERE NOT EXISTS (SELECT 1 FROM ({{s}}) s WHERE s.utm_epsg = c.utm_epsg AND (s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y) <= {RADIUS * RADIUS})"))
def buffer_anti_join(spark, sf_dir):
    return joins.within_anti(projected(spark, sf_dir, *CUSTOMERS), projected(spark, sf_dir, *SUPPLIERS), RADIUS).select("id")


@add(_sql(f"SELECT id FROM ({{pc}}) WHERE {geo.inside_sql('lon', 'lat', LASSO)}"))
def lasso_within(spark, sf_dir):
    return points(spark, sf_dir, *CUSTOMERS).filter(geo.expr(geo.inside_sql("lon", "lat", LASSO))).select("id")


def _cells(spark, sf_dir):
    place = lambda i: F.floor(F.col("embedding")[i].cast("double") * 40)
    return embeddings(spark, sf_dir).select(place(0).alias("cx"), place(1).alias("cy")).distinct()


_COMPONENTS = """WITH RECURSIVE cells AS (SELECT DISTINCT CAST(floor(CAST(embedding[1] AS DOUBLE) * 40) AS BIGINT) AS cx, CAST(floor(CAST(embedding[2] AS DOUBLE) * 40) AS BIGINT) AS cy FROM embeddings),
reached AS (SELECT cx, cy, cx AS rx, cy AS ry FROM cells UNION SELECT r.cx, r.cy, c.cx, c.cy FROM reached r JOIN cells c ON abs(c.cx - r.rx) + abs(c.cy - r.ry) = 1),
parts AS (SELECT cx, cy, min(rx * 4294967296 + (ry + 2147483648)) AS component FROM reached GROUP BY cx, cy)"""


@add(f"{_COMPONENTS} SELECT cx, cy, CAST(component AS BIGINT) AS component FROM parts")
def dissolve_components(spark, sf_dir):
    return dissolve.dissolved(_cells(spark, sf_dir))


def _area_sql() -> str:
    corners = ((0, 0), (1, 0), (1, 1), (0, 1))
    xy = [geo.forward_sql(f"({LON0}e0 + (cx + {i}) * {CELL}e0)", f"({LAT0}e0 + (cy + {j}) * {CELL}e0)", "zone") for i, j in corners]
    cols = ", ".join(f"{x} AS x{k}, {y} - CASE WHEN ({LAT0}e0 + (cy + {corners[k][1]}) * {CELL}e0) < 0 THEN 1e7 ELSE 0e0 END AS y{k}" for k, (x, y) in enumerate(xy))
    cross = " + ".join(f"(x{a} * y{b} - x{b} * y{a})" for a, b in ((0, 1), (1, 2), (2, 3), (3, 0)))
    return f"""{_COMPONENTS}, centre AS (SELECT component, count(*) AS n_cells, {LON0}e0 + (avg(cx) + 0.5) * {CELL}e0 AS lon, {LAT0}e0 + (avg(cy) + 0.5) * {CELL}e0 AS lat FROM parts GROUP BY component),
zoned AS (SELECT *, {geo.wrapped_zone_sql('lon')} AS zone FROM centre),
corners AS (SELECT p.component, {cols} FROM parts p JOIN zoned z ON z.component = p.component),
area AS (SELECT component, abs(sum(({cross}) / 2)) AS area FROM corners GROUP BY component)
SELECT CAST(z.component AS BIGINT) AS component, n_cells, round(lon, 6) AS lon, round(lat, 6) AS lat, {geo.epsg_sql('lon', 'lat', 'zone').replace('{string}', 'VARCHAR')} AS utm_epsg, round(area, 0) AS area FROM zoned z JOIN area a ON a.component = z.component"""


@add(_area_sql())
def polygon_area(spark, sf_dir):
    parts = keep(dissolve.dissolved(_cells(spark, sf_dir)))
    out = dissolve.areas(parts, CELL, LON0, LAT0)
    return out.select("component", "n_cells", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "utm_epsg", F.round("area", 0).alias("area"))
