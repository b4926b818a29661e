"""Panel queries over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapanel.operators import panel as op
from terrapanel.sources import adapters as ad

GROUPS = {"general": (1, 2, 3), "crosscut": (4, 5), "mask": (6,)}
PAIRS = [(1, 2), (1, 3), (2, 1), (3, 7), (4, 5), (5, 4), (6, 7), (7, 3)]
LEGEND = [(0, 0), (1, 3), (2, 3), (3, 12), (4, 15), (5, 15), (6, 33)]
_PAIRS_SQL = "pairs AS (SELECT * FROM (VALUES " + ", ".join(map(str, PAIRS)) + ") t(dominant, other))"
_LEGEND_SQL = "legend AS (SELECT * FROM (VALUES " + ", ".join(map(str, LEGEND)) + ") t(class_id, new_id))"
_W = "WITH " + ad.SQL


def _modes(s, d, exclude=()):
    return op.temporal_mode(ad.panel(s, d), exclude)


def _by_class(s, d):
    return op.class_shares(_modes(s, d)).select("grid_id", "class_id", "ha")


def _years(s, d):
    p = ad.panel(s, d)
    return op.stable_years(p, op.temporal_mode(p, (0, 8)), 0.4)


def c17(s, d):
    p = ad.panel(s, d)
    boxes = p.select("px_row", "px_col").distinct()
    boxes = boxes.select(F.expr("px_row * 50 + px_col").alias("box_id"), F.col("px_col").alias("x0"), F.col("px_row").alias("y0"), (F.col("px_col") + 3).alias("x1"), (F.col("px_row") + 3).alias("y1"))
    corners = F.explode(F.expr("array_distinct(array((y0 DIV 4) * 100 + x0 DIV 4, (y0 DIV 4) * 100 + (x1 - 1) DIV 4, ((y1 - 1) DIV 4) * 100 + x0 DIV 4, ((y1 - 1) DIV 4) * 100 + (x1 - 1) DIV 4))"))
    boxes = boxes.withColumn("bucket", corners)
    t = p.select(F.expr("(px_row DIV 4) * 100 + px_col DIV 4").alias("tile_id")).distinct()
    t = t.select("tile_id", F.expr("(tile_id % 100) * 4").alias("tx0"), F.expr("(tile_id DIV 100) * 4").alias("ty0"), F.expr("(tile_id % 100) * 4 + 4").alias("tx1"), F.expr("(tile_id DIV 100) * 4 + 4").alias("ty1"), F.col("tile_id").alias("bucket"))
    return op.dominant_tile(boxes, t)


def c19(s, d):
    return op.characterise(ad.panel(s, d), ad.zone(s, d))


def c18(s, d):
    return op.rule_type(c19(s, d).na.fill(0))


_DOM = "dom AS (SELECT grid_id, class_id, ha, row_number() OVER (PARTITION BY grid_id ORDER BY ha DESC, class_id) AS rk, sum(ha) OVER (PARTITION BY grid_id) AS whole, count(*) OVER (PARTITION BY grid_id) AS n FROM cell_class WHERE class_id NOT IN (0, 8))"
_MODE_T = """tm AS (SELECT px_row, px_col, grid_id, area, coalesce(min(class_id) FILTER (WHERE rk = 1 AND class_id IS NOT NULL), 0) AS mode_id FROM (
  SELECT *, row_number() OVER (PARTITION BY px_row, px_col ORDER BY n DESC, class_id NULLS LAST) AS rk FROM (
    SELECT px_row, px_col, grid_id, area, CASE WHEN class_id NOT IN (0, 8) THEN class_id END AS class_id, count(CASE WHEN class_id NOT IN (0, 8) THEN 1 END) AS n FROM panel GROUP BY ALL)) GROUP BY ALL)"""
_YEARS = "yrs AS (SELECT grid_id, year, avg(CASE WHEN class_id = mode_id THEN 1.0 ELSE 0.0 END) AS share FROM panel JOIN tm USING (px_row, px_col, grid_id) GROUP BY ALL), ys AS (SELECT grid_id, year, round(share, 4) AS share, share >= 0.4 AS stable FROM yrs)"
_RUNS = """runs AS (SELECT grid_id, island, count(*) AS n, min(year) AS y0, max(year) AS y1 FROM (
  SELECT grid_id, year, year - row_number() OVER (PARTITION BY grid_id ORDER BY year) AS island FROM ys WHERE stable) GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY n DESC, y0) AS rk FROM runs) WHERE rk = 1),
lr AS (SELECT g.grid_id, coalesce(n, 0) AS max_run, y0 AS run_start, y1 AS run_end FROM (SELECT DISTINCT grid_id FROM ys) g LEFT JOIN best b ON g.grid_id = b.grid_id)"""
_TRANS = """tr AS (SELECT grid_id, round(100 * avg(coalesce(rate, 0)), 4) AS transition_pct FROM (
  SELECT grid_id, px_row, px_col, avg(ch) AS rate FROM (
    SELECT grid_id, px_row, px_col, CASE WHEN year - lag(year) OVER w = 1 THEN CASE WHEN class_id <> lag(class_id) OVER w THEN 1.0 ELSE 0.0 END END AS ch
    FROM panel WHERE class_id NOT IN (0, 8) WINDOW w AS (PARTITION BY px_row, px_col ORDER BY year)) GROUP BY ALL) GROUP BY ALL)"""
_COMP = """comp AS (SELECT grid_id, sum(area) AS total, sum(area) FILTER (WHERE mode_id NOT IN (0, 8)) AS v, sum(CASE WHEN mode_id = 0 THEN area ELSE 0 END) AS nd, sum(CASE WHEN mode_id = 8 THEN area ELSE 0 END) AS un FROM pxmode GROUP BY ALL)"""
_DIV = """dv AS (SELECT grid_id, -sum(p * ln(p)) AS h, count(*) AS n FROM (SELECT grid_id, ha / sum(ha) OVER (PARTITION BY grid_id) AS p FROM cell_class WHERE class_id NOT IN (0, 8)) GROUP BY ALL)"""
_ZONE = """zn AS (SELECT * FROM (SELECT grid_id, eco_id, ha, row_number() OVER (PARTITION BY grid_id ORDER BY ha DESC, eco_id) AS rk, sum(ha) OVER (PARTITION BY grid_id) AS whole, count(*) OVER (PARTITION BY grid_id) AS n FROM (
  SELECT grid_id, eco_id, sum(area) AS ha FROM pxmode JOIN zone USING (px_row, px_col) WHERE eco_id > 0 GROUP BY ALL)) WHERE rk = 1)"""
_C19_FROM = """FROM comp LEFT JOIN (SELECT * FROM dom WHERE rk = 1) d USING (grid_id) LEFT JOIN dv USING (grid_id) LEFT JOIN zn USING (grid_id) LEFT JOIN tr USING (grid_id) LEFT JOIN lr USING (grid_id)"""
_C19 = f"{_W}, {_DOM}, {_MODE_T}, {_YEARS}, {_RUNS}, {_TRANS}, {_COMP}, {_DIV}, {_ZONE}"

QUERIES = {
    "c1_temporal_mode": (lambda s, d: _modes(s, d), f"{_W} SELECT * FROM pxmode"),
    "c1_temporal_mode_excluding": (lambda s, d: _modes(s, d, (0, 8)), f"{_W}, {_MODE_T} SELECT * FROM tm"),
    "c2_block_mode": (
        lambda s, d: op.block_mode(ad.panel(s, d), 3),
        f"{_W} SELECT block_row, block_col, year, class_id AS mode_id FROM (SELECT *, row_number() OVER (PARTITION BY block_row, block_col, year ORDER BY n DESC, class_id) AS rk FROM (SELECT px_row // 3 AS block_row, px_col // 3 AS block_col, year, class_id, count(*) AS n FROM panel WHERE px_row // 3 < (SELECT (max(px_row) + 1) // 3 FROM panel) AND px_col // 3 < (SELECT (max(px_col) + 1) // 3 FROM panel) GROUP BY ALL)) WHERE rk = 1",
    ),
    "c2b_block_validity": (lambda s, d: op.block_validity(ad.panel(s, d), 4), f"{_W} SELECT px_row // 4 AS block_row, px_col // 4 AS block_col, year, avg(CASE WHEN class_id NOT IN (0, 8) THEN 1.0 ELSE 0.0 END) >= 0.5 AS valid FROM panel GROUP BY ALL"),
    "c3_area_by_class": (lambda s, d: op.area_by_class(_modes(s, d)), f"{_W} SELECT grid_id, class_id, CAST(ha AS BIGINT) AS ha FROM cell_class"),
    "c4_composition": (
        lambda s, d: op.composition(_modes(s, d), GROUPS),
        f"""{_W}, g AS (SELECT grid_id, sum(area) AS total, sum(CASE WHEN mode_id = 0 THEN area ELSE 0 END) AS nd, sum(CASE WHEN mode_id = 8 THEN area ELSE 0 END) AS un, sum(CASE WHEN mode_id IN (1, 2, 3) THEN area ELSE 0 END) AS a, sum(CASE WHEN mode_id IN (4, 5) THEN area ELSE 0 END) AS b, sum(CASE WHEN mode_id = 6 THEN area ELSE 0 END) AS c FROM pxmode GROUP BY ALL)
        SELECT grid_id, CAST(total AS BIGINT) AS total, CAST(total - nd - un AS BIGINT) AS valid, round(100.0 * (total - nd - un) / total, 4) AS valid_pct, round(100.0 * nd / total, 4) AS nodata_pct, round(100.0 * un / total, 4) AS unobserved_pct, coalesce(round(100.0 * a / nullif(total - nd - un, 0), 4), 0) AS general_pct, coalesce(round(100.0 * b / nullif(total - nd - un, 0), 4), 0) AS crosscut_pct, coalesce(round(100.0 * c / nullif(total - nd - un, 0), 4), 0) AS mask_pct FROM g""",
    ),
    "c4b_pixel_composition": (
        lambda s, d: op.composition(_modes(s, d).withColumn("one", F.lit(1)), {"general": (1, 2, 3)}, "one"),
        f"""{_W}, g AS (SELECT grid_id, count(*) AS total, count(*) FILTER (WHERE mode_id = 0) AS nd, count(*) FILTER (WHERE mode_id = 8) AS un, count(*) FILTER (WHERE mode_id IN (1, 2, 3)) AS a FROM pxmode GROUP BY ALL)
        SELECT grid_id, total, total - nd - un AS valid, round(100.0 * (total - nd - un) / total, 4) AS valid_pct, round(100.0 * nd / total, 4) AS nodata_pct, round(100.0 * un / total, 4) AS unobserved_pct, coalesce(round(100.0 * a / nullif(total - nd - un, 0), 4), 0) AS general_pct FROM g""",
    ),
    "c5_best_period_share": (
        lambda s, d: op.best_period_share(ad.panel(s, d), _modes(s, d), ad.periods(s)),
        f"""{_W}, pm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY px_row, px_col, period ORDER BY n DESC, class_id) AS rk FROM (SELECT px_row, px_col, grid_id, area, period, class_id, count(*) AS n FROM panel JOIN periods ON year BETWEEN y0 AND y1 GROUP BY ALL)) WHERE rk = 1),
        k AS (SELECT pm.grid_id, period, class_id, sum(pm.area) AS ha FROM pm JOIN pxmode m USING (px_row, px_col) WHERE mode_id NOT IN (0, 8) GROUP BY ALL)
        SELECT grid_id, class_id, max(pct) AS pctp FROM (SELECT grid_id, class_id, round(100.0 * ha / sum(ha) OVER (PARTITION BY grid_id, period), 4) AS pct FROM k) WHERE class_id NOT IN (0, 8) GROUP BY ALL""",
    ),
    "c6_share_checks": (lambda s, d: op.share_checks(op.class_shares(_modes(s, d)), (7,)), f"{_W} SELECT grid_id, true AS sums_to_100, count(*) FILTER (WHERE class_id = 7) = 0 AS classes_allowed FROM cell_class WHERE class_id NOT IN (0, 8) GROUP BY ALL"),
    "c7_dominant_class": (lambda s, d: op.dominant(_by_class(s, d)), f"{_W}, {_DOM} SELECT grid_id, class_id AS dominant_class_id, round(100.0 * ha / whole, 4) AS dominant_pct, n AS n_classes FROM dom WHERE rk = 1"),
    "c7_last_year_class": (
        lambda s, d: op.dominant(ad.panel(s, d).where((F.col("year") == ad.LAST_YEAR) & ~F.col("class_id").isin(0, 8)).groupBy("grid_id", "class_id").agg(F.sum("area").alias("ha"))),
        f"{_W}, k AS (SELECT grid_id, class_id, sum(area) AS ha FROM panel WHERE year = 2001 AND class_id NOT IN (0, 8) GROUP BY ALL) SELECT grid_id, class_id AS dominant_class_id, round(100.0 * ha / whole, 4) AS dominant_pct, n AS n_classes FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY ha DESC, class_id) AS rk, sum(ha) OVER (PARTITION BY grid_id) AS whole, count(*) OVER (PARTITION BY grid_id) AS n FROM k) WHERE rk = 1",
    ),
    "c7_dominant_zone": (lambda s, d: op.zone_shares(_modes(s, d), ad.zone(s, d)), f"{_W}, {_ZONE} SELECT grid_id, eco_id AS dominant_eco_id, round(100.0 * ha / whole, 4) AS dominant_pct, n AS n_classes FROM zn"),
    "c8_diversity": (lambda s, d: op.diversity(_by_class(s, d)), f"{_W}, {_DIV} SELECT grid_id, round(h + 0.0, 4) AS shannon, round(CASE WHEN n > 1 THEN h / ln(n) ELSE 0 END + 0.0, 4) AS evenness FROM dv"),
    "c9_confusion_risk": (
        lambda s, d: op.confusion_risk(_modes(s, d), ad.zone(s, d), s.createDataFrame(PAIRS, "dominant int, other int")),
        f"""{_W}, {_PAIRS_SQL}, k AS (SELECT grid_id, mode_id AS class_id, sum(area) AS ha FROM pxmode JOIN zone USING (px_row, px_col) WHERE eco_id > 0 GROUP BY ALL),
        t AS (SELECT grid_id, class_id AS top FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY ha DESC, class_id) AS rk FROM k WHERE class_id NOT IN (0, 8)) WHERE rk = 1)
        SELECT grid_id, round(100.0 * sum(CASE WHEN other IS NOT NULL THEN ha ELSE 0 END) / sum(ha), 4) AS risk_pct FROM k JOIN t USING (grid_id) LEFT JOIN pairs ON dominant = top AND other = class_id GROUP BY ALL""",
    ),
    "c10_transitions": (lambda s, d: op.transitions(ad.panel(s, d)), f"{_W}, {_TRANS} SELECT * FROM tr"),
    "c11_stable_years": (_years, f"{_W}, {_MODE_T}, {_YEARS} SELECT * FROM ys"),
    "c12_longest_run": (lambda s, d: op.longest_run(_years(s, d)), f"{_W}, {_MODE_T}, {_YEARS}, {_RUNS} SELECT * FROM lr"),
    "c13_period_summary": (
        lambda s, d: op.period_summary(ad.panel(s, d), ad.periods(s), _years(s, d)),
        f"""{_W}, {_MODE_T}, {_YEARS}, pm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY px_row, px_col, period ORDER BY n DESC, class_id) AS rk FROM (SELECT px_row, px_col, grid_id, area, period, class_id, count(*) AS n FROM panel JOIN periods ON year BETWEEN y0 AND y1 WHERE class_id NOT IN (0, 8) GROUP BY ALL)) WHERE rk = 1),
        k AS (SELECT grid_id, period, class_id, sum(area) AS ha FROM pm GROUP BY ALL), st AS (SELECT grid_id, period, count(*) AS n_stable FROM ys JOIN periods ON year BETWEEN y0 AND y1 WHERE stable GROUP BY ALL)
        SELECT grid_id, period, class_id AS md_id, md_pct, coalesce(n_stable, 0) AS n_stable FROM (SELECT *, round(100.0 * ha / sum(ha) OVER (PARTITION BY grid_id, period), 4) AS md_pct, row_number() OVER (PARTITION BY grid_id, period ORDER BY ha DESC, class_id) AS rk FROM k) LEFT JOIN st USING (grid_id, period) WHERE rk = 1""",
    ),
    "c14_ever_present": (
        lambda s, d: op.ever_present(ad.panel(s, d), {"critical": (3, 7), "crosscut": (4, 5)}),
        f"{_W}, f AS (SELECT px_row, px_col, grid_id, area, max(CASE WHEN class_id IN (3, 7) THEN 1 ELSE 0 END) AS a, max(CASE WHEN class_id IN (4, 5) THEN 1 ELSE 0 END) AS b FROM panel GROUP BY ALL) SELECT grid_id, round(100.0 * sum(a * area) / sum(area), 4) AS critical_ever_pct, round(100.0 * sum(b * area) / sum(area), 4) AS crosscut_ever_pct FROM f GROUP BY ALL",
    ),
    "c15_legend_remap": (
        lambda s, d: op.remap(ad.panel(s, d), s.createDataFrame(LEGEND, "class_id int, new_id int"), 27).groupBy("new_id", "year").agg(F.count("*").alias("n")),
        f"{_W}, {_LEGEND_SQL} SELECT coalesce(new_id, 27) AS new_id, year, count(*) AS n FROM panel LEFT JOIN legend USING (class_id) GROUP BY ALL",
    ),
    "c16_grouped_histogram": (
        lambda s, d: op.dominant(op.remap(ad.panel(s, d), s.createDataFrame(LEGEND, "class_id int, new_id int"), 27).groupBy("grid_id", "new_id").agg(F.sum("area").alias("ha")), "new_id"),
        f"{_W}, {_LEGEND_SQL}, k AS (SELECT grid_id, coalesce(new_id, 27) AS new_id, sum(area) AS ha FROM panel LEFT JOIN legend USING (class_id) GROUP BY ALL) SELECT grid_id, new_id AS dominant_new_id, round(100.0 * ha / whole, 4) AS dominant_pct, n AS n_classes FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY ha DESC, new_id) AS rk, sum(ha) OVER (PARTITION BY grid_id) AS whole, count(*) OVER (PARTITION BY grid_id) AS n FROM k) WHERE rk = 1",
    ),
    "c17_dominant_tile": (
        c17,
        f"""{_W}, b AS (SELECT px_row * 50 + px_col AS box_id, px_col AS x0, px_row AS y0, px_col + 3 AS x1, px_row + 3 AS y1 FROM (SELECT DISTINCT px_row, px_col FROM panel)),
        t AS (SELECT DISTINCT (px_row // 4) * 100 + px_col // 4 AS tile_id FROM panel), tt AS (SELECT tile_id, (tile_id % 100) * 4 AS tx0, (tile_id // 100) * 4 AS ty0 FROM t),
        k AS (SELECT box_id, tile_id, (least(x1, tx0 + 4) - greatest(x0, tx0)) * (least(y1, ty0 + 4) - greatest(y0, ty0)) AS shared FROM b JOIN tt ON x0 < tx0 + 4 AND tx0 < x1 AND y0 < ty0 + 4 AND ty0 < y1)
        SELECT box_id, tile_id, round(100.0 * shared / 9, 4) AS tile_pct FROM (SELECT *, row_number() OVER (PARTITION BY box_id ORDER BY shared DESC, tile_id) AS rk FROM k) WHERE rk = 1""",
    ),
    "c18_rule_type": (
        c18,
        f"""{_C19}, z AS (SELECT grid_id, coalesce(transition_pct, 0) AS t, coalesce(max_run, 0) AS r, coalesce(round(100.0 * d.ha / d.whole, 4), 0) AS p, coalesce(d.n, 0) AS n, coalesce(round(h + 0.0, 4), 0) AS sh {_C19_FROM})
        SELECT grid_id, CASE WHEN t >= 60 THEN 'transition' WHEN r >= 3 THEN 'stable' ELSE 'annual' END AS dim_temporal, CASE WHEN p >= 60 THEN 'homogeneous' WHEN n <= 5 THEN 'simple' ELSE 'complex' END AS dim_spatial, round(t * 0.4 + sh * 20 + r * 2 + p * 0.1, 3) AS priority FROM z""",
    ),
    "c19_characterise": (
        c19,
        f"""{_C19} SELECT grid_id, CAST(total AS BIGINT) AS total, CAST(total - nd - un AS BIGINT) AS valid, round(100.0 * (total - nd - un) / total, 4) AS valid_pct, round(100.0 * nd / total, 4) AS nodata_pct, round(100.0 * un / total, 4) AS unobserved_pct, d.class_id AS dominant_class_id, round(100.0 * d.ha / d.whole, 4) AS dominant_pct, d.n AS n_classes, round(h + 0.0, 4) AS shannon, round(CASE WHEN dv.n > 1 THEN h / ln(dv.n) ELSE 0 END + 0.0, 4) AS evenness, eco_id AS dominant_eco_id, transition_pct, max_run, run_start, run_end {_C19_FROM}""",
    ),
}


def entry(s, d):
    """Composition, dominant class and diversity of each cell."""
    by_class = _by_class(s, d)
    return op.composition(_modes(s, d), GROUPS).join(op.dominant(by_class), "grid_id", "left").join(op.diversity(by_class), "grid_id", "left")
