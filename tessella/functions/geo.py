"""UTM projection, zones and polygon tests as SQL expressions, which stay in generated code.

Expressions are built as text that Spark and other SQL engines read alike; numbers carry an exponent, so that none is
taken for a decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid's series, sixth order in the third flattening.
ECCENTRICITY = 0.08181919084262149
RADIUS = 6367449.145823415
ALPHA = (8.377318206245e-4, 7.608527773802e-7, 1.197645482619e-9, 2.429150213015e-12, 5.750164242924e-15)
BETA = (8.377321640579e-4, 5.905870152220e-8, 1.673482665344e-10, 2.164798110491e-13, 3.787930968626e-16)
DELTA = (3.356551468969e-3, 6.571873148459e-6, 1.764656426454e-8, 5.387753890448e-11, 1.764007516012e-13)
SCALE = 0.9996


def num(x: float) -> str:
    return f"{x!r}" if "e" in repr(x) else f"{x!r}e0"


def _sinh(x: str) -> str:
    return f"((exp({x}) - exp(-({x}))) / 2e0)"


def _cosh(x: str) -> str:
    return f"((exp({x}) + exp(-({x}))) / 2e0)"


def _atanh(x: str) -> str:
    return f"(ln((1e0 + ({x})) / (1e0 - ({x}))) / 2e0)"


def zone_sql(lon: str) -> str:
    """Number of the UTM zone; 61 at 180 degrees."""
    return f"(cast(floor(({lon} + 180e0) / 6e0) AS int) + 1)"


def wrapped_zone_sql(lon: str) -> str:
    """Number of the UTM zone, 1 to 60."""
    return f"(cast(floor(({lon} + 180e0) / 6e0) AS int) % 60 + 1)"


def epsg_sql(lon: str, lat: str, zone: str | None = None) -> str:
    zone = zone or wrapped_zone_sql(lon)
    return f"concat('EPSG:', CASE WHEN {lat} >= 0e0 THEN '326' ELSE '327' END, lpad(cast({zone} AS {{string}}), 2, '0'))"


def forward_sql(lon: str, lat: str, zone: str) -> tuple[str, str]:
    """Easting and northing in metres."""
    sin_lat = f"sin(radians({lat}))"
    t = _sinh(f"{_atanh(sin_lat)} - {num(ECCENTRICITY)} * {_atanh(f'{num(ECCENTRICITY)} * {sin_lat}')}")
    turn = f"radians({lon} - (6e0 * {zone} - 183e0))"
    xi, eta = f"atan2({t}, cos({turn}))", _atanh(f"sin({turn}) / sqrt(1e0 + {t} * {t})")
    east = " + ".join([eta, *(f"{num(a)} * cos({2 * j}e0 * {xi}) * {_sinh(f'{2 * j}e0 * {eta}')}" for j, a in enumerate(ALPHA, 1))])
    north = " + ".join([xi, *(f"{num(a)} * sin({2 * j}e0 * {xi}) * {_cosh(f'{2 * j}e0 * {eta}')}" for j, a in enumerate(ALPHA, 1))])
    k = num(SCALE * RADIUS)
    return f"(5e5 + {k} * ({east}))", f"({k} * ({north}) + CASE WHEN {lat} < 0e0 THEN 1e7 ELSE 0e0 END)"


def inverse_sql(easting: str, northing: str, zone: str, south: str) -> tuple[str, str]:
    """Longitude and latitude in degrees; `south` is a condition."""
    k = num(SCALE * RADIUS)
    xi, eta = f"(({northing} - CASE WHEN {south} THEN 1e7 ELSE 0e0 END) / {k})", f"(({easting} - 5e5) / {k})"
    x = " - ".join([xi, *(f"{num(b)} * sin({2 * j}e0 * {xi}) * {_cosh(f'{2 * j}e0 * {eta}')}" for j, b in enumerate(BETA, 1))])
    y = " - ".join([eta, *(f"{num(b)} * cos({2 * j}e0 * {xi}) * {_sinh(f'{2 * j}e0 * {eta}')}" for j, b in enumerate(BETA, 1))])
    chi = f"asin(sin({x}) / {_cosh(y)})"
    lat = " + ".join([chi, *(f"{num(d)} * sin({2 * j}e0 * {chi})" for j, d in enumerate(DELTA, 1))])
    return f"(6e0 * {zone} - 183e0 + degrees(atan2({_sinh(y)}, cos({x}))))", f"degrees({lat})"


def inside_sql(x: str, y: str, ring: list[tuple[float, float]]) -> str:
    """Whether a point lies inside a ring (crossing number); points on an edge are outside."""
    edges = list(zip(ring, [*ring[1:], ring[0]], strict=True))
    crossings, on_edge = [], []
    for (x1, y1), (x2, y2) in edges:
        a, b, c, d = map(num, map(float, (x1, y1, x2, y2)))
        cross = f"(({c}) - ({a})) * ({y} - ({b})) - (({d}) - ({b})) * ({x} - ({a}))"
        if (x1, y1) != (x2, y2):
            on_edge.append(f"({cross} = 0e0 AND {x} BETWEEN least({a}, {c}) AND greatest({a}, {c}) AND {y} BETWEEN least({b}, {d}) AND greatest({b}, {d}))")
        if y1 != y2:
            crossings.append(f"CASE WHEN (({b}) > {y}) <> (({d}) > {y}) AND {x} < (({c}) - ({a})) * ({y} - ({b})) / (({d}) - ({b})) + ({a}) THEN 1 ELSE 0 END")
    return f"(({' + '.join(crossings)}) % 2 = 1 AND NOT ({' OR '.join(on_edge)}))"


def expr(sql: str) -> Column:
    return F.expr(sql.replace("{string}", "string"))


def projected(df, lon: str = "lon", lat: str = "lat", x: str = "x", y: str = "y"):
    """Adds utm_zone, utm_epsg, x and y; materialise before joining on them, or joins repeat the series."""
    east, north = forward_sql(lon, lat, "utm_zone")
    df = df.withColumn("utm_zone", expr(wrapped_zone_sql(lon))).withColumn("utm_epsg", expr(epsg_sql(lon, lat, "utm_zone")))
    return df.withColumns({x: expr(east), y: expr(north)})
