"""Grid, geodesy, spectral and spatial-join queries over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapanel.functions import geodesy as geo
from terrapanel.functions import indices as ix
from terrapanel.operators import lattice as lat
from terrapanel.operators import panel as op
from terrapanel.sources import adapters as ad

_W = "WITH " + ad.SQL


def charts(s, d):
    """One chart for each supplier, with pixel bounds."""
    t = ad.table(s, d, "supplier")
    return t.select(F.concat(F.lit("ch-"), (F.col("s_nationkey") + 1).cast("string"), F.lit("-"), F.col("s_suppkey").cast("string")).alias("chart"), (F.col("s_suppkey") * 100).cast("int").alias("x0"), F.lit(0).alias("y0"), (F.col("s_suppkey") * 100 + 17 + F.col("s_nationkey")).cast("int").alias("x1"), (13 + F.col("s_nationkey") % 5).cast("int").alias("y1"))


_CH = "ch AS (SELECT 'ch-' || CAST(s_nationkey + 1 AS VARCHAR) || '-' || CAST(s_suppkey AS VARCHAR) AS chart, CAST(s_suppkey * 100 AS INT) AS x0, 0 AS y0, CAST(s_suppkey * 100 + 17 + s_nationkey AS INT) AS x1, CAST(13 + s_nationkey % 5 AS INT) AS y1 FROM supplier)"
_CELLS = """cells AS (SELECT printf('%s_4x4_c%03d_r%03d', chart, c, r) AS grid_id, chart, c AS col_idx, r AS row_idx, x0 + c * 4 AS x0, y0 + r * 4 AS y0, x0 + c * 4 + 4 AS x1, y0 + r * 4 + 4 AS y1
  FROM (SELECT *, CAST(unnest(range((x1 - x0) // 4)) AS INT) AS c FROM ch), (SELECT CAST(unnest(range(20)) AS INT) AS r) WHERE r < (y1 - y0) // 4)"""


def cells(s, d):
    return lat.cells_of_chart(charts(s, d), 4)


def boxes(s, d):
    """Overlapping boxes from parts: place by key, side by size."""
    side = 2 + F.col("p_size") % 2
    return ad.table(s, d, "part").select(F.col("p_partkey").alias("box_id"), (F.col("p_partkey") % 50).alias("x0"), F.expr("p_partkey DIV 50").alias("y0"), (F.col("p_partkey") % 50 + side).alias("x1"), (F.expr("p_partkey DIV 50") + side).alias("y1"))


_BOX = "box AS (SELECT p_partkey AS box_id, p_partkey % 50 AS x0, p_partkey // 50 AS y0, p_partkey % 50 + 2 + p_size % 2 AS x1, p_partkey // 50 + 2 + p_size % 2 AS y1 FROM part)"
_PAIR = "pr AS (SELECT a.box_id AS a, b.box_id AS b, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS area FROM box a JOIN box b ON a.box_id < b.box_id AND least(a.x1, b.x1) >= greatest(a.x0, b.x0) AND least(a.y1, b.y1) >= greatest(a.y0, b.y0))"


def points(s, d):
    t = ad.table(s, d, "customer")
    return t.select(F.col("c_custkey").alias("id"), (F.lit(-76.0) + (F.col("c_custkey") * 7 % 1000) / 100.0).alias("lon"), (F.lit(-56.0) + (F.col("c_custkey") * 13 % 3900) / 100.0).alias("lat"), F.col("c_nationkey").alias("k"))


_PT = "pt AS (SELECT c_custkey AS id, -76.0 + (c_custkey * 7 % 1000) / 100.0 AS lon, -56.0 + (c_custkey * 13 % 3900) / 100.0 AS lat, c_nationkey AS k FROM customer)"
_E = 0.08181919084262149


def _qsql(x):
    s = f"sin(radians({x}))"
    return f"(1 - {_E}*{_E}) * ({s} / (1 - {_E}*{_E} * {s} * {s}) - ln((1 - {_E} * {s}) / (1 + {_E} * {s})) / (2 * {_E}))"


def obs(s, d):
    """Observations: integer transforms of quantity and price as reflectances, and a quality word."""
    t = ad.table(s, d, "lineitem")
    p = (F.floor("l_extendedprice") % 97 + 1) / 100.0
    q = F.col("l_quantity").cast("int")
    return t.select(*ad.pixel("l_partkey"), F.col("l_orderkey").alias("scene_id"), F.col("l_linenumber").alias("line"), F.year("l_shipdate").alias("year"), ((q % 13 + 1) / 100.0).alias("blue"), ((q % 17 + 3) / 100.0).alias("green"), ((q % 19 + 5) / 100.0).alias("red"), p.alias("nir"), ((q % 29 + 7) / 100.0).alias("swir1"), ((q % 11 + 9) / 100.0).alias("swir2"), (F.col("l_orderkey") % 4096).cast("int").alias("qa"))


OBS_SQL = """obs AS (SELECT CAST(l_partkey // 50 AS INT) AS px_row, CAST(l_partkey % 50 AS INT) AS px_col, l_orderkey AS scene_id, l_linenumber AS line, CAST(year(l_shipdate) AS INT) AS year,
 (CAST(l_quantity AS INT) % 13 + 1) / 100.0 AS blue, (CAST(l_quantity AS INT) % 17 + 3) / 100.0 AS green, (CAST(l_quantity AS INT) % 19 + 5) / 100.0 AS red, (CAST(floor(l_extendedprice) AS BIGINT) % 97 + 1) / 100.0 AS nir, (CAST(l_quantity AS INT) % 29 + 7) / 100.0 AS swir1, (CAST(l_quantity AS INT) % 11 + 9) / 100.0 AS swir2, CAST(l_orderkey % 4096 AS INT) AS qa FROM lineitem)"""
_BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
_ND = lambda a, b: f"(({a}) - ({b})) / nullif(({a}) + ({b}), 0)"
_IDX_SQL = {
    "ndvi": _ND("nir", "red"), "ndbi": _ND("swir1", "nir"), "ndmi": _ND("nir", "swir1"), "ndsi": _ND("green", "swir1"), "ui": _ND("swir2", "nir"), "ndwi": _ND("nir", "swir1"), "mndwi": _ND("green", "swir1"),
    "mbi": "(swir1 - swir2 - nir) / nullif(swir1 + swir2 + nir, 0) + 0.5", "bu": f"{_ND('swir1', 'nir')} - {_ND('nir', 'red')}", "ebbi": "(swir1 - nir) / (10 * sqrt(swir1 + swir2))", "savi": "1.5 * (nir - red) / (nir + red + 0.5)",
    "pri": _ND("blue", "green"), "cai": "swir2 / nullif(swir1, 0)", "evi": "2.5 * (nir - red) / nullif(nir + 6 * red - 7.5 * blue + 1, 0)", "evi2": "2.5 * (nir - red) / (nir + 2.4 * red + 1)", "gcvi": "nir / nullif(green, 0) - 1",
    "hall_cover": "exp(-0.017 * red * 100 - 0.007 * nir * 100 - 0.079 * swir2 * 100 + 5.22)", "hall_height": "exp(-0.039 * red * 100 - 0.011 * nir * 100 - 0.026 * swir1 * 100 + 4.13)",
}


def _cols(*names):
    return [F.col(n) for n in names]


def e6(s, d):
    out = ix.indices(*_cols(*_BANDS))
    return obs(s, d).groupBy("year").agg(*(F.round(F.avg(v), 4).alias(k) for k, v in out.items()))


ENDMEMBERS = {"gv": (0.05, 0.09, 0.04, 0.61, 0.30, 0.10), "npv": (0.14, 0.17, 0.22, 0.30, 0.55, 0.30), "soil": (0.20, 0.30, 0.34, 0.58, 0.60, 0.58), "cloud": (0.90, 0.96, 0.80, 0.78, 0.72, 0.65)}


def _fractions(s, d):
    return obs(s, d).select("year", *(v.alias(k) for k, v in ix.unmix(_cols(*_BANDS), ENDMEMBERS).items()))


def _unmix_sql():
    import numpy as np

    w = np.linalg.pinv(np.array(list(ENDMEMBERS.values())).T)
    parts = [f"greatest(({' + '.join(f'({x!r}) * {b}' for x, b in zip(row.tolist(), _BANDS, strict=True))}) * 100, 0.0) AS {n}" for n, row in zip(ENDMEMBERS, w, strict=True)]
    return f"fr AS (SELECT *, 100.0 - (gv + npv + soil + cloud) AS shade FROM (SELECT year, {', '.join(parts)} FROM obs))"


def e9(s, d):
    f = _fractions(s, d)
    out = ix.fraction_indices(*_cols("gv", "npv", "soil", "cloud", "shade"))
    return f.groupBy("year").agg(*(F.round(F.avg(v), 3).alias(k) for k, v in out.items()))


def _wide(x):
    return f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, -1.0), 1.0) * 100 + 100 END"


_GVS = "100 * gv / nullif(gv + npv + soil + cloud, 0)"


def geodesic_sql(pairs: str, rounds: int = 8) -> str:
    """CTEs from ``pairs`` (lon1, lat1, lon2, lat2 and others) to ``metres``, the geodesic's length, by rounds written out."""
    f = 1 / 298.257223563
    out = f"v0 AS (SELECT *, atan((1 - {f}) * tan(radians(lat1))) AS u1, atan((1 - {f}) * tan(radians(lat2))) AS u2, radians(lon2 - lon1) AS dl, radians(lon2 - lon1) AS lam FROM {pairs})"
    step = """SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / ss END AS sa, atan2(ss, cs) AS sg FROM (
  SELECT *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM {0})"""
    more = "SELECT *, CASE WHEN c2 = 0 THEN 0 ELSE cs - 2 * sin(u1) * sin(u2) / c2 END AS cm FROM (SELECT *, 1 - sa * sa AS c2 FROM ({0}))"
    drop = "EXCLUDE (ss, cs, sa, sg, c2, cm)"
    for k in range(rounds):
        c = f"({f} / 16 * c2 * (4 + {f} * (4 - 3 * c2)))"
        out += f",\nv{k + 1} AS (SELECT * {drop} REPLACE (dl + (1 - {c}) * {f} * sa * (sg + {c} * ss * (cm + {c} * cs * (2 * cm * cm - 1))) AS lam) FROM ({more.format(step.format(f'v{k}'))}))"
    a, b = 6378137.0, 6378137.0 * (1 - f)
    ks = f"(c2 * {(a * a - b * b) / (b * b)})"
    big = f"(1 + {ks} / 16384 * (4096 + {ks} * (-768 + {ks} * (320 - 175 * {ks}))))"
    low = f"({ks} / 1024 * (256 + {ks} * (-128 + {ks} * (74 - 47 * {ks}))))"
    d = f"({low} * ss * (cm + {low} / 4 * (cs * (2 * cm * cm - 1) - {low} / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3))))"
    return out + f",\ngeo AS (SELECT *, CASE WHEN ss = 0 THEN 0 ELSE {b} * {big} * (sg - {d}) END AS metres FROM ({more.format(step.format(f'v{rounds}'))}))"


QUERIES = {
    "a3_pixels_with_halo": (
        lambda s, d: lat.with_halo(ad.panel(s, d).select(F.expr("(px_row DIV 5) * 10 + px_col DIV 5").alias("cell_id"), F.expr("CAST(px_row DIV 5 AS INT)").alias("row_idx"), F.expr("CAST(px_col DIV 5 AS INT)").alias("col_idx")).distinct(), ad.panel(s, d).select("px_row", "px_col").distinct(), 5, 2),
        f"{_W}, c AS (SELECT DISTINCT grid_id AS cell_id, px_row // 5 AS r, px_col // 5 AS c FROM panel), p AS (SELECT DISTINCT px_row, px_col FROM panel) SELECT cell_id, px_row, px_col, px_row // 5 = r AND px_col // 5 = c AS is_core FROM c JOIN p ON px_row BETWEEN r * 5 - 2 AND r * 5 + 6 AND px_col BETWEEN c * 5 - 2 AND c * 5 + 6",
    ),
    "a1_window_scan": (
        lambda s, d: lat.window_scan(ad.panel(s, d), ad.panel(s, d).select("grid_id").distinct().select("grid_id", *(F.expr(x).cast("int").alias(y) for x, y in (("(grid_id DIV 10) * 5 - 1", "r0"), ("(grid_id DIV 10) * 5 + 5", "r1"), ("(grid_id % 10) * 5 - 1", "c0"), ("(grid_id % 10) * 5 + 5", "c1")))), "grid_id", range(ad.FIRST_YEAR, ad.LAST_YEAR + 1)),
        f"{_W} SELECT g.grid_id, CAST(g.grid_id // 10 * 5 + r.r AS INT) AS px_row, CAST(g.grid_id % 10 * 5 + c.r AS INT) AS px_col, y.y AS year, coalesce(class_id, 0) AS class_id FROM (SELECT DISTINCT grid_id FROM panel) g, (SELECT unnest(range(-1, 6)) AS r) r, (SELECT unnest(range(-1, 6)) AS r) c, (SELECT CAST(unnest(range(1995, 2002)) AS INT) AS y) y LEFT JOIN panel p ON p.px_row = g.grid_id // 10 * 5 + r.r AND p.px_col = g.grid_id % 10 * 5 + c.r AND p.year = y.y",
    ),
    "a4_chart_zone": (lambda s, d: charts(s, d).select("chart", F.split("chart", "-")[1].cast("int").alias("zone_id"), F.col("chart").rlike("^ch-[0-9]+-[0-9]+$").alias("valid_name")), f"WITH {_CH} SELECT chart, CAST(split_part(chart, '-', 2) AS INT) AS zone_id, regexp_matches(chart, '^ch-[0-9]+-[0-9]+$') AS valid_name FROM ch"),
    "b1_anchor": (lambda s, d: points(s, d).select("id", lat.snap_up(F.col("lon"), -76.0, 0.03).alias("anchor")), f"WITH {_PT} SELECT id, CAST(ceil((lon + 76.0) / 0.03 - 1e-9) AS INT) AS anchor FROM pt"),
    "b2_cells": (cells, f"WITH {_CH}, {_CELLS} SELECT * FROM cells"),
    "b4_tile_grid": (
        lambda s, d: charts(s, d).withColumn("c", F.explode(F.sequence(F.lit(0), F.ceil((F.col("x1") - F.col("x0")) / 4).cast("int") - 1))).select("chart", "c", F.round((F.least("x1", F.col("x0") + (F.col("c") + 1) * 4) - F.col("x0") - F.col("c") * 4) / 4.0, 4).alias("inside")).where("inside >= 0.5"),
        f"WITH {_CH} SELECT chart, c, round((least(x1, x0 + (c + 1) * 4) - x0 - c * 4) / 4.0, 4) AS inside FROM (SELECT *, CAST(unnest(range(CAST(ceil((x1 - x0) / 4.0) AS INT))) AS INT) AS c FROM ch) WHERE (least(x1, x0 + (c + 1) * 4) - x0 - c * 4) / 4.0 >= 0.5",
    ),
    "b6_quad_area": (
        lambda s, d: points(s, d).select("id", F.round(geo.quad_area_ha(F.col("lon"), F.col("lat"), F.col("lon") + 0.1, F.col("lat") + 0.1), 3).alias("ha")),
        f"WITH {_PT} SELECT id, round(6378137.0 * 6378137.0 * radians(lon + 0.1 - lon) * ({_qsql('lat + 0.1')} - {_qsql('lat')}) / 2 / 10000, 3) AS ha FROM pt",
    ),
    "b7_cell_width_height": (lambda s, d: points(s, d).select("id", F.round(geo.geodesic_m("lon", "lat", F.col("lon") + 0.1, "lat"), 2).alias("width_m"), F.round(geo.geodesic_m("lon", "lat", "lon", F.col("lat") + 0.1), 2).alias("height_m")), f"WITH {_PT}, two AS (SELECT id, 'w' AS side, lon AS lon1, lat AS lat1, lon + 0.1 AS lon2, lat AS lat2 FROM pt UNION ALL SELECT id, 'h', lon, lat, lon, lat + 0.1 FROM pt), {geodesic_sql('two')} SELECT id, round(max(metres) FILTER (WHERE side = 'w'), 2) AS width_m, round(max(metres) FILTER (WHERE side = 'h'), 2) AS height_m FROM geo GROUP BY id"),
    "b8_utm_epsg": (lambda s, d: points(s, d).select("id", geo.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg")), f"WITH {_PT} SELECT id, CAST(floor((lon + 180) / 6) + 1 + CASE WHEN lat < 0 THEN 32700 ELSE 32600 END AS INT) AS epsg FROM pt"),
    "b9_utm_scale": (
        lambda s, d: points(s, d).select("id", F.round(geo.utm_areal_scale(F.lit(200000) + F.col("id") * 50 % 600000), 8).alias("scale"), (F.abs(geo.utm_areal_scale(F.lit(200000) + F.col("id") * 50 % 600000) - 1) > 0.0005).alias("distorted")),
        f"WITH {_PT} SELECT id, round(pow(0.9996 * (1 + pow((200000 + id * 50 % 600000 - 500000) / 6371000.0, 2) / 2), 2), 8) AS scale, abs(pow(0.9996 * (1 + pow((200000 + id * 50 % 600000 - 500000) / 6371000.0, 2) / 2), 2) - 1) > 0.0005 AS distorted FROM pt",
    ),
    "b10_regrid": (
        lambda s, d: lat.regrid(ad.panel(s, d).select("px_row", "px_col").distinct(), ad.zone(s, d).select(F.col("px_row").alias("src_row"), F.col("px_col").alias("src_col"), "eco_id"), 0.4, 0.7).select("px_row", "px_col", "eco_id"),
        f"{_W}, p AS (SELECT DISTINCT px_row, px_col FROM panel) SELECT p.px_row, p.px_col, eco_id FROM p LEFT JOIN zone z ON z.px_row = CAST(floor((p.px_row + 0.5) * 0.4) AS INT) AND z.px_col = CAST(floor((p.px_col + 0.5) * 0.7) AS INT)",
    ),
    "b12_rebuild_geometry": (
        lambda s, d: cells(s, d).withColumn("rebuilt", F.regexp_extract("grid_id", "_c([0-9]+)_", 1).cast("int") * 4).groupBy("chart").agg(F.count("*").alias("n"), F.percentile((F.col("x1") - F.col("x0")) * 1.0 + F.col("rebuilt"), F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))[1].alias("p50")),
        f"WITH {_CH}, {_CELLS} SELECT chart, count(*) AS n, quantile_cont(CAST(4 + col_idx * 4 AS DOUBLE), 0.5) AS p50 FROM cells GROUP BY ALL",
    ),
    "b13_grid_checks": (lambda s, d: lat.grid_checks(cells(s, d), 4), f"WITH {_CH}, {_CELLS} SELECT chart, count(*) AS n_cells, count(DISTINCT grid_id) AS n_keys, count(*) FILTER (WHERE step <> 4) AS n_bad_steps FROM (SELECT *, x0 - lag(x0) OVER (PARTITION BY chart, row_idx ORDER BY col_idx) AS step FROM cells) GROUP BY ALL"),
    "b14_missing_years": (
        lambda s, d: ad.panel(s, d).select("px_row", "px_col").distinct().withColumn("year", F.explode(F.sequence(F.lit(ad.FIRST_YEAR), F.lit(ad.LAST_YEAR)))).join(ad.panel(s, d).select("px_row", "px_col", "year"), ["px_row", "px_col", "year"], "left_anti").groupBy("year").agg(F.count("*").alias("n_missing")),
        f"{_W} SELECT y AS year, count(*) AS n_missing FROM (SELECT DISTINCT px_row, px_col FROM panel) p, (SELECT CAST(unnest(range(1995, 2002)) AS INT) AS y) ANTI JOIN panel q ON q.px_row = p.px_row AND q.px_col = p.px_col AND q.year = y GROUP BY ALL",
    ),
    "b15_decimate": (lambda s, d: lat.decimate(op.temporal_mode(ad.panel(s, d)), 4, "mode_id"), f"{_W} SELECT px_row // 4 AS row_idx, px_col // 4 AS col_idx, arg_min(mode_id, px_row * 50 + px_col) AS mode_id FROM pxmode GROUP BY ALL"),
    "e6_spectral_indices": (e6, f"WITH {OBS_SQL} SELECT year, " + ", ".join(f"round(avg({v}), 4) AS {k}" for k, v in _IDX_SQL.items()) + " FROM obs GROUP BY year"),
    "e7_ad_hoc_index": (lambda s, d: obs(s, d).groupBy("year").agg(F.round(F.avg((F.col("nir") - F.col("red")) / (F.col("nir") + F.col("red") + 1e-6)), 4).alias("v")), f"WITH {OBS_SQL} SELECT year, round(avg((nir - red) / (nir + red + 1e-6)), 4) AS v FROM obs GROUP BY year"),
    "e8_unmixing": (lambda s, d: _fractions(s, d).groupBy("year").agg(*(F.round(F.avg(c), 3).alias(c) for c in (*ENDMEMBERS, "shade"))), f"WITH {OBS_SQL}, {_unmix_sql()} SELECT year, " + ", ".join(f"round(avg({c}), 3) AS {c}" for c in (*ENDMEMBERS, "shade")) + " FROM fr GROUP BY year"),
    "e9_fraction_indices": (
        e9,
        f"WITH {OBS_SQL}, {_unmix_sql()} SELECT year, round(avg({_GVS}), 3) AS gvs, round(avg({_wide(_ND(_GVS, 'npv + soil'))}), 3) AS ndfi, round(avg({_wide(_ND('gv + npv', 'soil'))}), 3) AS sefi, round(avg({_wide(_ND('gv + npv', 'soil + shade'))}), 3) AS wefi, round(avg({_wide(_ND('gv + shade', 'soil'))}), 3) AS fns FROM fr GROUP BY year",
    ),
    "e10_quality_bits": (
        lambda s, d: obs(s, d).groupBy("year").agg(*(F.count(F.when(v, 1)).alias(f"{n}_{k}") for n in ("landsat", "sentinel") for k, v in ix.quality_masks(F.col("qa"), n).items())),
        f"WITH {OBS_SQL} SELECT year, count(*) FILTER (WHERE qa & 8 <> 0) AS landsat_cloud, count(*) FILTER (WHERE qa & 16 <> 0) AS landsat_shadow, count(*) FILTER (WHERE qa & 1024 <> 0) AS sentinel_cloud, count(*) FILTER (WHERE qa & 2048 <> 0) AS sentinel_shadow FROM obs GROUP BY year",
    ),
    "e11_cloud_score": (
        lambda s, d: obs(s, d).groupBy("year").agg(F.round(F.avg(ix.cloud_score(*_cols(*_BANDS))), 4).alias("score")),
        f"WITH {OBS_SQL} SELECT year, round(avg(least(1.0, greatest((blue - 0.1) / 0.2, 0.0), greatest((blue + green + red - 0.2) / 0.6, 0.0), greatest((nir + swir1 + swir2 - 0.3) / 0.5, 0.0), greatest(({_ND('green', 'swir1')} - 0.8) / -0.2, 0.0))), 4) AS score FROM obs GROUP BY year",
    ),
    "e12_scale_factors": (lambda s, d: obs(s, d).groupBy("year").agg(F.sum(F.floor(F.col("nir") * 10000 + 0.5)).alias("scaled"), F.round(F.sum(F.col("qa") * 0.0000275 - 0.2), 2).alias("sr")), f"WITH {OBS_SQL} SELECT year, CAST(sum(floor(nir * 10000 + 0.5)) AS BIGINT) AS scaled, round(sum(qa * 0.0000275 - 0.2), 2) AS sr FROM obs GROUP BY year"),
    "e19_circular": (lambda s, d: obs(s, d).groupBy("year").agg(F.round(F.avg(F.sin(F.radians(F.col("qa") % 360))), 4).alias("sin"), F.round(F.avg(F.cos(F.radians(F.col("qa") % 360))), 4).alias("cos")), f"WITH {OBS_SQL} SELECT year, round(avg(sin(radians(qa % 360))), 4) AS sin, round(avg(cos(radians(qa % 360))), 4) AS cos FROM obs GROUP BY year"),
    "e20_stretch": (
        lambda s, d: ix.stretch(obs(s, d).select("year", "scene_id", "line", "nir", "red"), ["year"], ["nir", "red"]).groupBy("year").agg(F.sum("nir").alias("nir"), F.sum("red").alias("red")),
        f"WITH {OBS_SQL}, p AS (SELECT year, quantile_cont(nir, 0.02) AS n0, quantile_cont(nir, 0.98) AS n1, quantile_cont(red, 0.02) AS r0, quantile_cont(red, 0.98) AS r1 FROM (SELECT year, CAST(nir AS DOUBLE) AS nir, CAST(red AS DOUBLE) AS red FROM obs) GROUP BY year) SELECT year, CAST(sum(floor(least(greatest((nir - n0) / (n1 - n0), 0.0), 1.0) * 255)) AS BIGINT) AS nir, CAST(sum(floor(least(greatest((red - r0) / (r1 - r0), 0.0), 1.0) * 255)) AS BIGINT) AS red FROM (SELECT year, CAST(nir AS DOUBLE) AS nir, CAST(red AS DOUBLE) AS red FROM obs) JOIN p USING (year) GROUP BY year",
    ),
    "e21_z_scores": (
        lambda s, d: ix.z_scores(obs(s, d).select("year", "px_row", F.when(F.col("qa") % 7 != 0, F.col("nir")).alias("nir")), ["year"], ["nir"]).groupBy("year", "px_row").agg(F.round(F.avg("nir"), 4).alias("z")),
        f"WITH {OBS_SQL}, o AS (SELECT year, px_row, CASE WHEN qa % 7 <> 0 THEN CAST(nir AS DOUBLE) END AS nir FROM obs), m AS (SELECT year, median(nir) AS md FROM o GROUP BY year), f AS (SELECT year, px_row, coalesce(nir, md) AS nir FROM o JOIN m USING (year)), t AS (SELECT year, avg(nir) AS a, stddev_pop(nir) AS sd FROM f GROUP BY year) SELECT year, px_row, round(avg((nir - a) / CASE WHEN sd > 0 THEN sd ELSE 1 END), 4) AS z FROM f JOIN t USING (year) GROUP BY ALL",
    ),
    "f5_covered_boxes": (
        lambda s, d: lat.overlaps(boxes(s, d), boxes(s, d).where("box_id % 2 = 0"), 4).where("a <> b").select(F.col("a").alias("box_id")).distinct(),
        f"WITH {_BOX} SELECT DISTINCT a.box_id FROM box a JOIN box b ON b.box_id % 2 = 0 AND a.box_id <> b.box_id AND least(a.x1, b.x1) >= greatest(a.x0, b.x0) AND least(a.y1, b.y1) >= greatest(a.y0, b.y0)",
    ),
    "f6_overlap_pairs": (lambda s, d: lat.overlaps(boxes(s, d), boxes(s, d), 4, True), f"WITH {_BOX}, {_PAIR} SELECT * FROM pr"),
    "f7_exclude_overlaps": (
        lambda s, d: lat.exclude_overlapping(boxes(s, d).where("box_id % 10 <> 0"), boxes(s, d).where("box_id % 10 = 0"), 4),
        f"WITH {_BOX} SELECT * FROM box a WHERE box_id % 10 <> 0 AND NOT EXISTS (SELECT 1 FROM box b WHERE b.box_id % 10 = 0 AND least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0))",
    ),
    "f8_pixel_in_cell": (
        lambda s, d: ad.panel(s, d).select("px_row", "px_col").distinct().join(ad.panel(s, d).select(F.expr("CAST(px_row DIV 7 AS INT)").alias("r"), F.expr("CAST(px_col DIV 7 AS INT)").alias("c")).distinct(), (F.expr("CAST(px_row DIV 7 AS INT)") == F.col("r")) & (F.expr("CAST(px_col DIV 7 AS INT)") == F.col("c"))).groupBy("r", "c").agg(F.count("*").alias("n")),
        f"{_W} SELECT px_row // 7 AS r, px_col // 7 AS c, count(*) AS n FROM (SELECT DISTINCT px_row, px_col FROM panel) GROUP BY ALL",
    ),
    "f9_year_in_period": (
        lambda s, d: ad.panel(s, d).join(F.broadcast(ad.periods(s)), F.col("year").between(F.col("y0"), F.col("y1"))).groupBy("period", "class_id").agg(F.count("*").alias("n")),
        f"{_W} SELECT period, class_id, count(*) AS n FROM panel JOIN periods ON year BETWEEN y0 AND y1 GROUP BY ALL",
    ),
    "f10_neighbours": (
        lambda s, d: lat.neighbours(op.temporal_mode(ad.panel(s, d)).where("mode_id = 3").select(F.expr("px_row * 50 + px_col").alias("cell_id"), F.col("px_row").alias("row_idx"), F.col("px_col").alias("col_idx"))),
        f"{_W}, m AS (SELECT px_row, px_col, px_row * 50 + px_col AS id FROM pxmode WHERE mode_id = 3) SELECT a.id AS a, b.id AS b FROM m a JOIN m b ON abs(a.px_row - b.px_row) <= 1 AND abs(a.px_col - b.px_col) <= 1 AND a.id <> b.id",
    ),
    "f11_nearest_valid": (
        lambda s, d: lat.nearest_valid(op.temporal_mode(ad.panel(s, d)).where("mode_id in (0, 8)"), op.temporal_mode(ad.panel(s, d)).where("mode_id in (2, 5)").withColumn("value", F.col("mode_id")), 2),
        f"{_W}, h AS (SELECT px_row, px_col FROM pxmode WHERE mode_id IN (0, 8)), v AS (SELECT px_row AS vr, px_col AS vc, mode_id AS value FROM pxmode WHERE mode_id IN (2, 5)) SELECT px_row, px_col, value FROM (SELECT *, row_number() OVER (PARTITION BY px_row, px_col ORDER BY (px_row - vr) * (px_row - vr) + (px_col - vc) * (px_col - vc), vr, vc) AS rk FROM h, v) WHERE rk = 1",
    ),
    "k14_overlap_audit": (
        lambda s, d: lat.overlap_audit(boxes(s, d), 4),
        f"WITH {_BOX}, {_PAIR} SELECT CAST((SELECT sum((x1 - x0) * (y1 - y0)) FROM box) AS BIGINT) AS sum_area, count(*) FILTER (WHERE area > 0) AS n_overlaps, count(*) FILTER (WHERE area = 0) AS n_contacts, CAST(coalesce(sum(area), 0) AS BIGINT) AS shared_area FROM pr",
    ),
}
