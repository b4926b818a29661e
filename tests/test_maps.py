"""Projected coordinates, cut polygons, grids in tiles, and lists of scenes against other formulas and plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrapanel.functions import projection as pr
from terrapanel.operators import scenes, tilegrid


def by_arc_length(lon, lat, zone):
    """UTM by the classic series in powers of the difference in longitude, good to a millimetre within a zone."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    p, d = math.radians(lat), math.radians(lon - (zone * 6 - 183))
    n, t, c, w = a / math.sqrt(1 - e2 * math.sin(p) ** 2), math.tan(p) ** 2, ep2 * math.cos(p) ** 2, math.cos(p) * d
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p) - 35 * e2**3 / 3072 * math.sin(6 * p))
    x = k0 * n * (w + (1 - t + c) * w**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * w**5 / 120) + 500000
    y = k0 * (m + n * math.tan(p) * (w * w / 2 + (5 - t + 9 * c + 4 * c * c) * w**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * w**6 / 720))
    return x, y + (1e7 if lat < 0 else 0)


def test_utm_agrees_with_another_series(spark):
    rng = random.Random(1)
    rows = [(rng.uniform(-78, -66), rng.uniform(-56, -17)) for _ in range(60)] + [(-69.0, -33.0), (9.5, 47.0), (-69.0, 0.0)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    x, y = pr.utm(F.col("lon"), F.col("lat"), F.floor((F.col("lon") + 180) / 6) + 1, F.col("lat") < 0)
    for r in df.select("lon", "lat", x.alias("x"), y.alias("y")).collect():
        wx, wy = by_arc_length(r.lon, r.lat, math.floor((r.lon + 180) / 6) + 1)
        assert abs(r.x - wx) < 1e-3 and abs(r.y - wy) < 2e-3
    on = df.where("lon = -69").select(*pr.utm(F.col("lon"), F.col("lat"), F.lit(19), F.col("lat") < 0)).collect()
    assert all(abs(r[0] - 500000) < 1e-6 for r in on)


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


SHAPES = "id int, ring array<struct<x:double,y:double>>, x0 double, y0 double, x1 double, y1 double"


def test_areas_centres_and_cuts(spark):
    square, triangle, ell = [(0, 0), (4, 0), (4, 4), (0, 4)], [(0, 0), (6, 0), (0, 6)], [(0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4)]
    rows = [(1, ring(square), 1.0, 1.0, 3.0, 9.0), (2, ring(triangle), 0.0, 0.0, 4.0, 4.0), (3, ring(ell), 0.5, 0.5, 3.0, 3.0), (4, ring(square), 5.0, 5.0, 6.0, 6.0), (5, ring(square[::-1]), -1.0, -1.0, 9.0, 9.0), (6, ring([(1, 1), (1, 1), (1, 1)]), 0.0, 0.0, 2.0, 2.0)]
    df = spark.createDataFrame(rows, SHAPES)
    cut = pr.clip(F.col("ring"), *(F.col(c) for c in ("x0", "y0", "x1", "y1")))
    cx, cy = pr.centroid(F.col("ring"))
    got = {r.id: r for r in df.select("id", pr.signed_area(F.col("ring")).alias("area"), F.when(F.size(cut) > 2, pr.signed_area(cut)).otherwise(0.0).alias("inside"), cx.alias("cx"), cy.alias("cy")).collect()}
    assert [got[k].area for k in range(1, 7)] == [16, 18, 7, 16, -16, 0]
    assert [got[k].inside for k in range(1, 7)] == pytest.approx([6, 14, 0.5 * 2.5 + 0.5 * 2, 0, -16, 0])
    assert (got[1].cx, got[1].cy) == (2, 2) and (got[2].cx, got[2].cy) == (2, 2) and (got[6].cx, got[6].cy) == (1, 1)


@pytest.mark.parametrize("seed", range(2))
def test_cut_area_by_sampling_rows(spark, seed):
    """Against thin horizontal slices of a convex polygon."""
    rng = random.Random(seed)
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(9))
    points = [(5 * math.cos(t), 3 * math.sin(t)) for t in angles]
    box = (-2.0, -1.0, 3.0, 1.5)
    area, n = 0.0, 20000
    for k in range(n):
        y = box[1] + (k + 0.5) * (box[3] - box[1]) / n
        xs = [p[0] + (y - p[1]) / (q[1] - p[1]) * (q[0] - p[0]) for p, q in zip(points, points[1:] + points[:1]) if (p[1] <= y) != (q[1] <= y)]
        if len(xs) == 2:
            area += max(0.0, min(max(xs), box[2]) - max(min(xs), box[0])) * (box[3] - box[1]) / n
    df = spark.createDataFrame([(1, ring(points), *box)], SHAPES)
    got = df.select(pr.signed_area(pr.clip(F.col("ring"), *(F.col(c) for c in ("x0", "y0", "x1", "y1"))))).first()[0]
    assert got == pytest.approx(area, rel=1e-3)


def test_metric_grid_has_one_origin(spark):
    corner = lambda lon, lat: {"lon": lon, "lat": lat}
    box = lambda x, y: [corner(x, y), corner(x + 0.2, y), corner(x + 0.2, y + 0.2), corner(x, y + 0.2)]
    tiles = spark.createDataFrame([("a", 19, True, box(-69.2, -33.0)), ("b", 19, True, box(-69.1, -33.0))], "tile string, zone int, south boolean, ring array<struct<lon:double,lat:double>>")
    rows = tilegrid.metric_grid(tiles, 2000.0, F.struct(F.lit(100.0).alias("x"), F.lit(0.0).alias("y")), "2x2").collect()
    at = {(r.tile, r.col_off, r.row_off): (r.x0, r.y0) for r in rows}
    shared = {k[1:] for k in at if k[0] == "a"} & {k[1:] for k in at if k[0] == "b"}
    assert shared and all(at["a", *k] == at["b", *k] for k in shared) and all(r.share >= 0.999 for r in rows)
    assert all((r.x0 - 100) % 2000 == 0 and r.grid_id == f"{r.tile}_2x2_c{r.col_idx:03d}_r{r.row_idx:03d}" for r in rows)


def test_pixel_rectangles_lie_on_multiples(spark):
    tiles = spark.createDataFrame([("t", ring([(2.6, 1.4), (9.4, 1.4), (9.4, 9.6), (2.6, 9.6)])), ("off", ring([(90, 90), (91, 90), (91, 91), (90, 91)]))], "tile string, ring array<struct<x:double,y:double>>")
    rows = {(r.col_off, r.row_off): r for r in tilegrid.pixel_rectangles(tiles, 2, 0.0, 10.0, 1.0, 10, 9, "2x2").collect()}
    # Pixels 3 to 8 across; rows 0 to 8 from the top, of which the first counts; the raster ends at row 9.
    assert set(rows) == {(c, r) for c in (4, 6) for r in (2, 4, 6)} and rows[4, 2].col_idx == 1 and rows[4, 2].row_idx == 1


def test_lists_move_whole_and_in_order(spark):
    records = [("b", 1999, 0, 1, ["s1", "s2"]), ("a", 1999, 0, 2, ["s3", "s1"]), ("a", 1999, 0, 1, ["s9"]), ("c", 2000, 1, 1, []), ("b", 1999, 0, 2, [f"t{k}" for k in range(40)])]
    src = [("a", 0, 0, 10, 10), ("b", 10, 0, 20, 10), ("c", 500, 0, 510, 10)]
    tgt = [("m", 5, 5, 15, 8), ("edge", -5, 0, 0, 10), ("none", 100, 100, 110, 110)]
    box = "x0 int, y0 int, x1 int, y1 int"
    out = scenes.transfer_lists(spark.createDataFrame(records, "name string, year int, satellite int, seq int, scenes array<string>"), spark.createDataFrame(src, f"name string, {box}"), spark.createDataFrame(tgt, f"tile string, {box}"), 8)
    got = {(r.tile, r.year): r.scenes for r in out.collect()}
    assert got["m", 1999] == ["s9", "s3", "s1", "s2"] + [f"t{k}" for k in range(40)] and got["edge", 1999] == ["s9", "s3", "s1"]
    assert got["none", 1999] == got["m", 2000] == [] and len(got) == 6


def test_boxes_differ_by_class(spark):
    shares = spark.createDataFrame([(1, -69.0, -33.0, 1, 7.0), (2, -75.0, -33.0, 1, 8.0), (3, -69.0, -33.0, 2, None), (4, -69.0, -33.0, 9, 5.0)], "id int, lon double, lat double, class_id int, pct double")
    boxes = spark.createDataFrame([(1, 19, 4e5, 6e5, 6e6, 7e6), (2, 19, 0.0, 1e5, 0.0, 1e5)], "class_id int, zone int, xmin double, xmax double, ymin double, ymax double")
    assert {r.id: (r.inside, r.outside_pct) for r in tilegrid.outside_class_box(shares, boxes).collect()} == {1: (True, 0.0), 2: (False, 8.0), 3: (False, 0.0), 4: (None, 0.0)}
