"""UTM coordinates, and areas and cuts of polygons on the map, as Columns.

Polygons are arrays of points ``x, y`` (``lon, lat`` before projection) without the first point repeated at the end.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapanel.functions.geodesy import _E, A, INV_F, K0, utm_zone
from terrapanel.sources.shared import spread

_N = (1 / INV_F) / (2 - 1 / INV_F)
#: Radius of the circle whose circumference is four meridian quadrants.
RECTIFYING = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
#: Coefficients of Krüger's series from conformal to rectifying coordinates, to the sixth power of the third flattening.
KRUEGER = (
    _N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3 + 41 / 180 * _N**4 - 127 / 288 * _N**5 + 7891 / 37800 * _N**6,
    13 / 48 * _N**2 - 3 / 5 * _N**3 + 557 / 1440 * _N**4 + 281 / 630 * _N**5 - 1983433 / 1935360 * _N**6,
    61 / 240 * _N**3 - 103 / 140 * _N**4 + 15061 / 26880 * _N**5 + 167603 / 181440 * _N**6,
    49561 / 161280 * _N**4 - 179 / 168 * _N**5 + 6601661 / 7257600 * _N**6,
    34729 / 80640 * _N**5 - 3418889 / 1995840 * _N**6,
    212378941 / 319334400 * _N**6,
)
FALSE_EAST, FALSE_NORTH = 500_000.0, 10_000_000.0


def _turned(lon: Column, lat: Column, meridian: Column) -> tuple[Column, Column]:
    """The tangent of the conformal latitude, and the angle from the meridian."""
    s = F.sin(F.radians(lat))
    return F.sinh(F.atanh(s) - _E * F.atanh(_E * s)), F.radians(lon - meridian)


def _sphere(t: Column, d: Column) -> tuple[Column, Column]:
    return F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))


def _series(xi: Column, eta: Column) -> tuple[Column, Column]:
    x, y = eta, xi
    for j, a in enumerate(KRUEGER, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return K0 * RECTIFYING * x, K0 * RECTIFYING * y


def transverse_mercator(lon: Column, lat: Column, meridian: Column) -> tuple[Column, Column]:
    """Coordinates in metres east of a central meridian and north of the equator, at the scale of a UTM zone."""
    return _series(*_sphere(*_turned(lon, lat, meridian)))


def utm(lon: Column, lat: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Easting and northing in a UTM zone, which need not be the point's own."""
    x, y = transverse_mercator(lon, lat, zone * 6 - 183)
    return x + FALSE_EAST, y + F.when(south, FALSE_NORTH).otherwise(0.0)


def to_utm(ring: Column, zone: Column, south: Column) -> Column:
    """A polygon of ``lon, lat`` in a UTM zone."""

    def point(p: Column) -> Column:
        # Inside a lambda nothing is shared: each step is worked out once by name, else every term of the series starts afresh.
        turned = F.struct(*(c.alias(n) for c, n in zip(_turned(p["lon"], p["lat"], zone * 6 - 183), ("t", "d"), strict=True)))
        sphere = lambda a: F.struct(*(c.alias(n) for c, n in zip(_sphere(a["t"], a["d"]), ("xi", "eta"), strict=True)))
        x_y = lambda b: (lambda x, y: F.struct((x + FALSE_EAST).alias("x"), (y + F.when(south, FALSE_NORTH).otherwise(0.0)).alias("y")))(*_series(b["xi"], b["eta"]))
        return let(turned, lambda a: let(sphere(a), x_y))

    return F.transform(ring, point)


def _next(ring: Column) -> Column:
    """The points that follow."""
    return F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def signed_area(ring: Column) -> Column:
    """The area of a polygon, over 0 if its points go round against the clock; sums go from the first point, for precision."""

    def area(r: Column) -> Column:
        x0, y0 = r[0]["x"], r[0]["y"]
        return _sum(F.zip_with(r, _next(r), lambda p, q: (p["x"] - x0) * (q["y"] - y0) - (q["x"] - x0) * (p["y"] - y0))) / 2

    return let(ring, area)


def centroid(ring: Column) -> tuple[Column, Column]:
    """The centre of a polygon's area; the mean of the points where it has none."""
    x0, y0 = ring[0]["x"], ring[0]["y"]
    cross = lambda p, q: (p["x"] - x0) * (q["y"] - y0) - (q["x"] - x0) * (p["y"] - y0)

    def along(c: str, zero: Column) -> Column:
        moment = _sum(F.zip_with(ring, _next(ring), lambda p, q: (p[c] + q[c] - 2 * zero) * cross(p, q)))
        return F.coalesce(zero + F.try_divide(moment, 6 * signed_area(ring)), _sum(F.transform(ring, lambda p: p[c])) / F.size(ring))

    return along("x", x0), along("y", y0)


def clip(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A polygon cut to a box, half-plane by half-plane; an empty array if nothing is left.  Areas are right for any simple
    polygon; where a concave one falls apart its parts hang together along the box."""
    plane = lambda along_x, edge, sign: F.struct(F.lit(along_x).alias("along_x"), edge.cast("double").alias("edge"), F.lit(sign).alias("sign"))
    planes = F.array(plane(True, x0, 1.0), plane(True, x1, -1.0), plane(False, y0, 1.0), plane(False, y1, -1.0))

    def cut(points: Column, h: Column) -> Column:
        own, other = lambda p: F.when(h["along_x"], p["x"]).otherwise(p["y"]), lambda p: F.when(h["along_x"], p["y"]).otherwise(p["x"])
        inside = lambda p: (own(p) - h["edge"]) * h["sign"] >= 0

        def between(p: Column, q: Column) -> Column:
            at = other(p) + (h["edge"] - own(p)) / (own(q) - own(p)) * (other(q) - other(p))
            return F.struct(F.when(h["along_x"], h["edge"]).otherwise(at).alias("x"), F.when(h["along_x"], at).otherwise(h["edge"]).alias("y"))

        step = lambda p, q: F.when(inside(p) & inside(q), F.array(q)).when(inside(p), F.array(between(p, q))).when(inside(q), F.array(between(p, q), q)).otherwise(F.slice(F.array(q), 1, 0))
        return F.flatten(F.zip_with(points, _next(points), step))

    return F.aggregate(planes, ring, cut)


def own_zone_area_km2(df: DataFrame, ring: str) -> DataFrame:
    """``df`` with ``epsg`` of the UTM zone of each polygon's centre (``ring`` has ``lon, lat``), its ``area_km2`` there, and the
    ``diameter_km`` of a circle as large."""
    df = spread(df).withColumn("_flat", F.transform(ring, lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y"))))
    lon, lat = centroid(F.col("_flat"))
    df = df.withColumn("_lon", lon).withColumn("_lat", lat)
    df = df.withColumn("epsg", utm_zone(F.col("_lon")) + F.when(F.col("_lat") < 0, 32700).otherwise(32600))
    df = df.withColumn("_map", to_utm(F.col(ring), utm_zone(F.col("_lon")), F.col("_lat") < 0))
    df = df.withColumn("area_km2", F.abs(signed_area(F.col("_map"))) / 1e6)
    return df.withColumn("diameter_km", 2 * F.sqrt(F.col("area_km2") / math.pi)).drop("_flat", "_lon", "_lat", "_map")


def size_summary(df: DataFrame, by: str) -> DataFrame:
    """Median, 10th and 90th percentile of areas and diameters in each group."""
    marks = {"median": 0.5, "p10": 0.1, "p90": 0.9}
    return df.groupBy(by).agg(F.count("area_km2").alias("n"), *(F.percentile(c, q).alias(f"{c}_{name}") for c in ("area_km2", "diameter_km") for name, q in marks.items()))
