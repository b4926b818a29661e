"""Masks of clouds and shadows against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrapanel.operators import composite, masks


def image(seed, n=9):
    rng = random.Random(seed)
    return {(s, r, c): rng.choice([None, *range(6)]) for s in (1, 2) for r in range(-2, n) for c in range(n) if rng.random() < 0.7}


@pytest.mark.parametrize("shape,least,reach", [("circle", True, 2), ("circle", False, 3), ("square", False, 1), ("square", True, 2)])
def test_focal_extremes_look_across_holes(spark, shape, least, reach):
    px = image(reach)
    near = lambda dr, dc: dr * dr + dc * dc <= reach * reach if shape == "circle" else max(abs(dr), abs(dc)) <= reach
    want = {}
    for s, r, c in px:
        seen = [v for (s2, r2, c2), v in px.items() if s2 == s and near(r2 - r, c2 - c) and v is not None]
        want[s, r, c] = (min if least else max)(seen) if seen else None
    df = spark.createDataFrame([(*k, v) for k, v in px.items()], "scene int, px_row int, px_col int, v int")
    got = {(x.scene, x.px_row, x.px_col): x.focal for x in masks.focal_extreme(df, "v", reach, least, ["scene"], shape).collect()}
    assert got == want


def test_spread_marks_each_place_once(spark):
    df = spark.createDataFrame([(0, 0), (0, 2)], "px_row int, px_col int")
    got = [(r.px_row, r.px_col) for r in masks.spread(df, 2).collect()]
    want = {(r + dr, c + dc) for r, c in ((0, 0), (0, 2)) for dr in range(-2, 3) for dc in range(-2, 3) if dr * dr + dc * dc <= 4}
    assert sorted(got) == sorted(want)


SCHEMA = "scene int, px_row int, px_col int, blue double, green double, red double, nir double, swir1 double, swir2 double, qa int"


def test_shadows_fall_away_from_the_sun(spark):
    rows = [(s, r, c, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 8 if (r, c) == (20, 20) else 0) for s in (1, 2, 3) for r in range(41) for c in range(41)]
    suns = {1: (0.0, 45.0), 2: (90.0, 30.0)}
    df = spark.createDataFrame(rows, SCHEMA)
    out = masks.all_masks(df, ["scene"], spark.createDataFrame([(s, *v) for s, v in suns.items()] + [(3, None, 40.0)], "scene int, sun_azimuth_angle double, sun_elevation_angle double"), (90, 240), 30.0, reach=1)
    got = {(r.scene, r.px_row, r.px_col) for r in out.where("cloudShadowTdomMask").collect()}
    want = set()
    for s, (azimuth, elevation) in suns.items():
        for h in (90, 240):
            far = math.tan(math.radians(90 - elevation)) * h / 30
            turn = math.radians(azimuth + 90)
            r, c = 20 + round(math.sin(turn) * far), 20 + round(math.cos(turn) * far)
            want |= {(s, r + dr, c + dc) for dr, dc in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))}
    assert got == {x for x in want if 0 <= x[1] <= 40 and 0 <= x[2] <= 40} and {x[0] for x in got} == {1, 2}
    assert out.columns[-5:] == list(masks.MASKS) and masks.apply_masks(out).count() == len(rows) - 3 - len(got)


def test_flags_choose_the_methods(spark):
    df = spark.createDataFrame([(1, 0, 0, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 24)], SCHEMA)
    suns = spark.createDataFrame([(1, 10.0, 40.0)], "scene int, sun_azimuth_angle double, sun_elevation_angle double")
    of = lambda **f: {c for c in masks.all_masks(df, ["scene"], suns, (100,), 30.0, **f).columns if c.endswith("Mask")}
    assert of(cloud_score=False, shadow_tdom=False) == {"cloudFlagMask", "cloudShadowFlagMask"}
    assert of(cloud_flag=False, cloud_score=False, shadow_flag=False, shadow_tdom=False) == {"cloudScoreMask", "tdomMask"}
    assert of(shadow_flag=False) == set(masks.MASKS) - {"cloudShadowFlagMask"}
    assert masks.apply_masks(df).count() == 1


def test_dark_outliers_are_eroded(spark):
    rows = [(s, r, c, 0.0, 0.0, 0.0, 0.1 if s == 9 and 1 <= r <= 4 and 1 <= c <= 4 else 0.4, 0.1 if s == 9 and 1 <= r <= 4 and 1 <= c <= 4 else 0.4, 0.1, 0) for s in range(5, 10) for r in range(6) for c in range(6)]
    out = masks.dark_outlier_mask(spark.createDataFrame(rows, SCHEMA), ["scene"], reach=1).where("tdomMask").collect()
    assert {(r.scene, r.px_row, r.px_col) for r in out} == {(9, r, c) for r in (2, 3) for c in (2, 3)}


def test_sliced_medians(spark):
    df = spark.createDataFrame([(1, float(i), i / 10) for i in range(9)], "k int, nir double, ndvi double")
    r = composite.extremes(df, ["k"], "ndvi", ["nir"]).first()
    assert (r.nir_median, r.nir_median_p25, r.nir_median_p75, r.nir_min, r.nir_max, r.nir_p1, r.nir_p99) == (4.0, 1.0, 7.0, 0.0, 8.0, 0.08, 7.92)
    assert df.where(F.lit(False)).count() == 0 == composite.extremes(df.where(F.lit(False)), ["k"], "ndvi", ["nir"]).count()
