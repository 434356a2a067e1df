"""Detected grid squares to polygons: components by shared edges, their boundary, rings, centroid and area."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.scratch import keep
from .graph import components


def dissolved(cells: DataFrame) -> DataFrame:
    """(cx, cy, component) of distinct grid squares; squares join over a shared edge, not over a corner.

    The component is the smallest packed position (cx, then cy) of its squares.
    """
    nodes = cells.select("cx", "cy").filter("cx is not null and cy is not null").distinct().select("cx", "cy", pack("cx", "cy").alias("node"))
    nodes = keep(nodes)
    steps = [nodes.select(F.col("node").alias("u"), pack(F.col("cx") + i, F.col("cy") + j).alias("v")) for i, j in ((1, 0), (0, 1))]
    edges = steps[0].unionByName(steps[1]).join(nodes.select(F.col("node").alias("v")), "v")
    found = components(edges)
    return nodes.join(found, "node", "left").select("cx", "cy", F.coalesce("component", "node").alias("component"))


def pack(x, y):
    """One long of two signed 31-bit positions, in their order."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return x.cast("long") * F.lit(1 << 32) + (y.cast("long") + F.lit(1 << 31))


def areas(cells: DataFrame, size: float, lon0: float = 0.0, lat0: float = 0.0) -> DataFrame:
    """(component, n_cells, lon, lat, utm_epsg, area): squares of `size` degrees, area in square metres in the zone of the
    centroid.  Edges that two squares share cancel in the shoelace sum, so it runs square by square, holes included."""
    lon, lat = F.lit(lon0) + F.col("cx") * size, F.lit(lat0) + F.col("cy") * size
    placed = cells.withColumn("lon", lon).withColumn("lat", lat)
    centre = placed.groupBy("component").agg(F.count("*").alias("n_cells"), (F.avg("lon") + size / 2).alias("clon"), (F.avg("lat") + size / 2).alias("clat"))
    centre = keep(centre.withColumn("zone", geo.expr(geo.wrapped_zone_sql("clon"))).withColumn("utm_epsg", geo.expr(geo.epsg_sql("clon", "clat", "zone"))))
    # corners counter-clockwise; all in the hemisphere's northing of the centroid, which cancels
    corners = F.array(*(F.struct(F.lit(i).alias("i"), (F.col("lon") + dx * size).alias("lo"), (F.col("lat") + dy * size).alias("la")) for i, (dx, dy) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1)))))
    points = placed.join(centre.select("component", "zone"), "component").select("component", "cx", "cy", "zone", F.explode(corners).alias("p")).select("component", "cx", "cy", "zone", "p.*")
    east, north = geo.forward_sql("lo", "la", "zone")
    points = points.withColumn("x", geo.expr(east)).withColumn("y", geo.expr(north) - F.when(F.col("la") < 0, 1e7).otherwise(0.0))
    rings = points.groupBy("component", "cx", "cy").agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("r"))
    cross = lambda a, b: F.col("r")[a]["x"] * F.col("r")[b]["y"] - F.col("r")[b]["x"] * F.col("r")[a]["y"]
    each = rings.select("component", ((cross(0, 1) + cross(1, 2) + cross(2, 3) + cross(3, 0)) / 2).alias("a"))
    area = each.groupBy("component").agg(F.abs(F.sum("a")).alias("area"))
    return centre.join(area, "component").select("component", "n_cells", F.col("clon").alias("lon"), F.col("clat").alias("lat"), "utm_epsg", "area")


def boundary(cells: DataFrame) -> DataFrame:
    """(component, x1, y1, x2, y2): directed edges with the component on their left; edges seen twice have cancelled."""
    corners = ((0, 0), (1, 0), (1, 1), (0, 1))
    sides = F.array(*(F.struct(*((F.col(c) + d).alias(n) for c, d, n in (("cx", a[0], "x1"), ("cy", a[1], "y1"), ("cx", b[0], "x2"), ("cy", b[1], "y2")))) for a, b in zip(corners, (*corners[1:], corners[0]), strict=True)))
    edges = cells.select("component", F.explode(sides).alias("e")).select("component", "e.*")
    back = edges.select("component", F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    return edges.join(back, ["component", "x1", "y1", "x2", "y2"], "left_anti")


def rings(cells: DataFrame) -> DataFrame:
    """(component, ring, hole, xs, ys) in grid positions; one component's boundary must fit one task."""

    def stitch(key: tuple, edges: pd.DataFrame) -> pd.DataFrame:
        ahead: dict[tuple, list[tuple]] = {}
        for x1, y1, x2, y2 in sorted(edges[["x1", "y1", "x2", "y2"]].itertuples(index=False, name=None)):
            ahead.setdefault((x1, y1), []).append((x2, y2))
        out = []
        while ahead:
            start = at = min(ahead)
            ring, came = [], None
            while True:
                ring.append(at)
                ways = ahead[at]
                # at a corner where two squares touch, turn left, so that rings do not cross
                pick = 0 if came is None or len(ways) == 1 else max(range(len(ways)), key=lambda i: came[0] * (ways[i][1] - at[1]) - came[1] * (ways[i][0] - at[0]))
                to = ways.pop(pick)
                if not ways:
                    del ahead[at]
                came, at = (to[0] - at[0], to[1] - at[1]), to
                if at == start:
                    break
            area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]], strict=True))
            out.append((key[0], len(out), area < 0, [p[0] for p in ring], [p[1] for p in ring]))
        return pd.DataFrame(out, columns=["component", "ring", "hole", "xs", "ys"])

    return boundary(cells).groupBy("component").applyInPandas(stitch, "component long, ring int, hole boolean, xs array<long>, ys array<long>")
