"""Variants and composed queries over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrapanel.operators import graph, lattice
from terrapanel.operators import panel as op
from terrapanel.operators import reviewplan as rp
from terrapanel.operators.superpixels import superpixels
from terrapanel.operators.sweep import parameter_sweep
from terrapanel.plans import audit_queries as aq
from terrapanel.plans import label_queries as lq
from terrapanel.plans import panel_queries as pq
from terrapanel.plans import selection_queries as sq
from terrapanel.plans.grid_queries import _BOX, OBS_SQL, boxes, obs
from terrapanel.plans.label_queries import _MJ, _SP, _SX
from terrapanel.sources import adapters as ad

_W = "WITH " + ad.SQL
_M = sq._M


SCALES, SIGMAS, PERCENTILES = (16, 25), (0.0, 1.0), (0.1, 0.5)


def sweep(s, d):
    """A sweep of which one row is there already, and one without its threshold."""
    done = s.createDataFrame([(16, 0.0, 0.1, 1, 2, 0.5, 3, 4, 5), (25, 1.0, 0.5, 1, 2, None, 3, 4, 5), (99, 0.0, 0.1, 1, 2, None, 3, 4, 5)], "scale int, sigma double, percentile double, n_segments long, n_edges long, threshold double, n_regions long, largest_px long, n_small long")
    return parameter_sweep(colours(s, d), ["v"], SCALES, SIGMAS, PERCENTILES, rounds=2, least=20, done=done).withColumn("threshold", F.round("threshold", 4))


def _sweep_sql() -> str:
    """The same steps with the combination in every key: smoothing, two rounds, parts, borders, distances, limits, merging."""
    ctes = [
        ad.SQL,
        f"cb AS (SELECT scale, sigma, CAST(greatest(2, floor(sqrt(scale))) AS INT) AS step FROM (SELECT CAST(unnest({list(SCALES)}) AS INT) AS scale), (SELECT CAST(unnest({list(SIGMAS)}) AS DOUBLE) AS sigma))",
        "im AS MATERIALIZED (SELECT scale, sigma, step, px_row AS r, px_col AS c, CAST(mode_id AS DOUBLE) AS v FROM pxmode, cb)",
        "bell AS (SELECT scale, sigma, d, CASE WHEN d = 0 THEN 1.0::DOUBLE ELSE exp(-(d * d) / (2 * sigma * sigma)) END AS w FROM cb, (SELECT unnest(range(-3, 4)) AS d) WHERE abs(d) <= 3 * sigma)",
        "ac AS MATERIALIZED (SELECT scale, sigma, r, c + d AS c, sum(w) AS u, sum(w * v) AS v FROM im JOIN bell USING (scale, sigma) GROUP BY scale, sigma, r, c + d)",
        "dn AS MATERIALIZED (SELECT scale, sigma, r + d AS r, c, sum(w * v) / sum(w * u) AS v FROM ac JOIN bell USING (scale, sigma) GROUP BY scale, sigma, r + d, c)",
        "hm AS MATERIALIZED (SELECT im.scale, im.sigma, step, im.r, im.c, dn.v, im.r // step AS br, im.c // step AS bc FROM im JOIN dn USING (scale, sigma, r, c))",
        "s0 AS MATERIALIZED (SELECT scale, sigma, br AS sr, bc AS sc, avg(r) AS mr, avg(c) AS mc, avg(v) AS mv FROM hm GROUP BY ALL)",
    ]
    for k in range(2):
        ctes.append(f"a{k} AS MATERIALIZED (SELECT scale, sigma, r, c, v, sr, sc FROM (SELECT hm.*, sr, sc, row_number() OVER (PARTITION BY hm.scale, hm.sigma, r, c ORDER BY 0.0::DOUBLE + (v - mv) * (v - mv) + 1.0::DOUBLE * ((r - mr) * (r - mr) + (c - mc) * (c - mc)) / (step * step), sr, sc) AS rk FROM hm JOIN s{k} z ON z.scale = hm.scale AND z.sigma = hm.sigma AND abs(br - sr) <= 1 AND abs(bc - sc) <= 1) WHERE rk = 1)")
        ctes.append(f"s{k + 1} AS MATERIALIZED (SELECT scale, sigma, sr, sc, avg(r) AS mr, avg(c) AS mc, avg(v) AS mv FROM a{k} GROUP BY scale, sigma, sr, sc)")
    ctes += [
        "pi AS MATERIALIZED (SELECT *, CAST(r AS BIGINT) * 4294967296 + c AS id FROM a1)",
        "pe AS MATERIALIZED (SELECT x.scale, x.sigma, x.id AS a, y.id AS b FROM pi x JOIN pi y ON x.scale = y.scale AND x.sigma = y.sigma AND x.sr = y.sr AND x.sc = y.sc AND abs(x.r - y.r) + abs(x.c - y.c) = 1)",
        "walk(scale, sigma, node, root) AS (SELECT scale, sigma, id, id FROM pi UNION SELECT pe.scale, pe.sigma, pe.b, walk.root FROM walk JOIN pe ON pe.a = walk.node AND pe.scale = walk.scale AND pe.sigma = walk.sigma)",
        "px AS MATERIALIZED (SELECT pi.*, patch FROM pi JOIN (SELECT scale, sigma, node AS id, min(root) AS patch FROM walk GROUP BY ALL) USING (scale, sigma, id))",
        "o0 AS MATERIALIZED (SELECT scale, sigma, patch, CASE WHEN row_number() OVER (PARTITION BY scale, sigma, sr, sc ORDER BY n DESC, patch) = 1 THEN patch END AS owner FROM (SELECT scale, sigma, sr, sc, patch, count(*) AS n FROM px GROUP BY ALL))",
        "bo AS MATERIALIZED (SELECT x.scale, x.sigma, x.patch AS p, y.patch AS q, count(*) AS n FROM px x JOIN px y ON x.scale = y.scale AND x.sigma = y.sigma AND abs(x.r - y.r) + abs(x.c - y.c) = 1 AND x.patch <> y.patch GROUP BY ALL)",
        """tn(turn, scale, sigma, patch, owner) AS (SELECT 0, * FROM o0 UNION ALL SELECT t.turn + 1, t.scale, t.sigma, t.patch, coalesce(t.owner, w.owner) FROM tn t LEFT JOIN (
  SELECT scale, sigma, p, owner FROM (SELECT bo.scale, bo.sigma, bo.p, b.owner, row_number() OVER (PARTITION BY bo.scale, bo.sigma, bo.p ORDER BY sum(bo.n) DESC, b.owner) AS rk FROM bo JOIN tn a ON a.patch = bo.p AND a.scale = bo.scale AND a.sigma = bo.sigma AND a.owner IS NULL JOIN tn b ON b.patch = bo.q AND b.scale = bo.scale AND b.sigma = bo.sigma AND b.owner IS NOT NULL GROUP BY bo.scale, bo.sigma, bo.p, b.owner) WHERE rk = 1) w ON w.p = t.patch AND w.scale = t.scale AND w.sigma = t.sigma WHERE t.turn < 20)""",
        "sg AS MATERIALIZED (SELECT px.scale, px.sigma, r, c, v, coalesce(owner, px.patch) AS segment FROM px JOIN tn ON tn.turn = 20 AND tn.scale = px.scale AND tn.sigma = px.sigma AND tn.patch = px.patch)",
        "nd AS MATERIALIZED (SELECT scale, sigma, segment, count(*) AS n, avg(v) AS v FROM sg GROUP BY ALL)",
        "ew AS MATERIALIZED (SELECT e.*, abs(x.v - y.v) AS weight FROM (SELECT DISTINCT x.scale, x.sigma, least(x.segment, y.segment) AS a, greatest(x.segment, y.segment) AS b FROM sg x JOIN sg y ON x.scale = y.scale AND x.sigma = y.sigma AND abs(x.r - y.r) + abs(x.c - y.c) = 1 AND x.segment <> y.segment) e JOIN nd x ON x.scale = e.scale AND x.sigma = e.sigma AND x.segment = a JOIN nd y ON y.scale = e.scale AND y.sigma = e.sigma AND y.segment = b)",
        "li AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT scale, sigma, CAST({p} AS DOUBLE) AS percentile, quantile_cont(weight, {p}) AS threshold FROM ew GROUP BY ALL" for p in PERCENTILES) + ")",
        "lk AS MATERIALIZED (SELECT scale, sigma, percentile, a, b FROM ew JOIN li USING (scale, sigma) WHERE weight < threshold UNION SELECT scale, sigma, percentile, b, a FROM ew JOIN li USING (scale, sigma) WHERE weight < threshold)",
        "wk(scale, sigma, percentile, node, root) AS (SELECT scale, sigma, percentile, segment, segment FROM nd JOIN li USING (scale, sigma) UNION SELECT lk.scale, lk.sigma, lk.percentile, lk.b, wk.root FROM wk JOIN lk ON lk.a = wk.node AND lk.scale = wk.scale AND lk.sigma = wk.sigma AND lk.percentile = wk.percentile)",
        "rg AS (SELECT scale, sigma, percentile, region, sum(n) AS n_px FROM (SELECT scale, sigma, percentile, node AS segment, min(root) AS region FROM wk GROUP BY ALL) JOIN nd USING (scale, sigma, segment) GROUP BY ALL)",
    ]
    new = "SELECT scale, sigma, percentile, (SELECT count(*) FROM nd WHERE nd.scale = rg.scale AND nd.sigma = rg.sigma) AS n_segments, (SELECT count(*) FROM ew WHERE ew.scale = rg.scale AND ew.sigma = rg.sigma) AS n_edges, round(any_value(threshold), 4) AS threshold, count(*) AS n_regions, CAST(max(n_px) AS BIGINT) AS largest_px, count(*) FILTER (WHERE n_px < 20) AS n_small FROM rg JOIN li USING (scale, sigma, percentile) WHERE NOT (scale = 16 AND sigma = 0 AND percentile = 0.1) GROUP BY scale, sigma, percentile"
    return "WITH RECURSIVE " + ", ".join(ctes) + f" {new} UNION ALL SELECT 16, 0.0, 0.1, 1, 2, 0.5, 3, 4, 5 UNION ALL SELECT 99, 0.0, 0.1, 1, 2, NULL, 3, 4, 5"


def block_panel(s, d):
    b = op.block_mode(ad.panel(s, d), 3)
    return b.select(F.col("block_row").alias("px_row"), F.col("block_col").alias("px_col"), F.expr("CAST((block_row DIV 2) * 10 + block_col DIV 2 AS INT)").alias("grid_id"), F.lit(1).alias("area"), "year", F.col("mode_id").alias("class_id"))


def core_patches(s, d):
    core = sq.px3(s, d).where("px_row % 5 between 1 and 3 and px_col % 5 between 1 and 3")
    found = graph.patches(core, "mode_id", 4)
    return found.withColumn("label", F.dense_rank().over(Window.partitionBy("mode_id").orderBy("patch"))).select("id", "mode_id", "label")


_CORE = """cr AS (SELECT px_row * 50 + px_col AS id, px_row, px_col, mode_id FROM pxmode WHERE mode_id IN (1, 2, 3, 4) AND px_row % 5 BETWEEN 1 AND 3 AND px_col % 5 BETWEEN 1 AND 3),
ce AS (SELECT a.id AS a, b.id AS b FROM cr a JOIN cr b ON a.mode_id = b.mode_id AND abs(a.px_row - b.px_row) + abs(a.px_col - b.px_col) = 1),
cp AS (WITH RECURSIVE walk(node, root) AS (SELECT id, id FROM cr UNION SELECT ce.b, walk.root FROM walk JOIN ce ON ce.a = walk.node) SELECT node AS id, min(root) AS patch FROM walk GROUP BY node)"""


def one_part(s, d):
    px = lq.seg_px(s, d).withColumn("id", F.expr("px_row * 50 + px_col"))
    return graph.patches(px, "segment_id", 4).groupBy("segment_id").agg(F.count_distinct("patch").alias("n_parts")).where("n_parts > 1")


_PARTS = """se AS (SELECT px_row * 50 + px_col AS id, px_row, px_col, segment_id FROM sx), sd AS (SELECT a.id AS a, b.id AS b FROM se a JOIN se b ON a.segment_id = b.segment_id AND abs(a.px_row - b.px_row) + abs(a.px_col - b.px_col) = 1),
sp2 AS (WITH RECURSIVE walk(node, root) AS (SELECT id, id FROM se UNION SELECT sd.b, walk.root FROM walk JOIN sd ON sd.a = walk.node) SELECT node AS id, min(root) AS patch FROM walk GROUP BY node)"""


def colours(s, d):
    return lq.modes(s, d).select("px_row", "px_col", F.col("mode_id").cast("double").alias("v"))


def one_part_each(s, d):
    """Superpixels, their pixels, and how many of them are in several parts."""
    px = superpixels(colours(s, d), ["v"], 5, 3).withColumn("id", F.expr("px_row * 50 + px_col"))
    parts = graph.patches(px, "segment", 4).groupBy("segment").agg(F.count_distinct("patch").alias("n_parts"), F.count("*").alias("n"))
    return parts.agg(F.count("*").alias("n_segments"), F.sum("n").alias("n_px"), F.count(F.when(F.col("n_parts") > 1, 1)).cast("int").alias("n_in_parts"))


def _super_sql() -> str:
    """Three rounds of assigning and moving, then parts, borders, and what the parts join turn by turn."""
    ctes = [ad.SQL, "hm AS MATERIALIZED (SELECT px_row AS r, px_col AS c, CAST(mode_id AS DOUBLE) AS v, px_row // 5 AS br, px_col // 5 AS bc FROM pxmode)", "s0 AS MATERIALIZED (SELECT br AS sr, bc AS sc, avg(r) AS mr, avg(c) AS mc, avg(v) AS mv FROM hm GROUP BY 1, 2)"]
    for k in range(3):
        ctes.append(f"""a{k} AS MATERIALIZED (SELECT r, c, v, sr, sc FROM (SELECT hm.*, sr, sc, row_number() OVER (PARTITION BY r, c ORDER BY 0.0::DOUBLE + (v - mv) * (v - mv) + 1.0::DOUBLE * ((r - mr) * (r - mr) + (c - mc) * (c - mc)) / 25, sr, sc) AS rk FROM hm JOIN s{k} ON abs(br - sr) <= 1 AND abs(bc - sc) <= 1) WHERE rk = 1)""")
        ctes.append(f"s{k + 1} AS MATERIALIZED (SELECT sr, sc, avg(r) AS mr, avg(c) AS mc, avg(v) AS mv FROM a{k} GROUP BY 1, 2)")
    ctes += [
        "pi AS MATERIALIZED (SELECT *, CAST(r AS BIGINT) * 4294967296 + c AS id FROM a2)",
        "pe AS MATERIALIZED (SELECT x.id AS a, y.id AS b FROM pi x JOIN pi y ON x.sr = y.sr AND x.sc = y.sc AND abs(x.r - y.r) + abs(x.c - y.c) = 1)",
        "walk(node, root) AS (SELECT id, id FROM pi UNION SELECT pe.b, walk.root FROM walk JOIN pe ON pe.a = walk.node)",
        "px AS MATERIALIZED (SELECT pi.*, patch FROM pi JOIN (SELECT node AS id, min(root) AS patch FROM walk GROUP BY 1) USING (id))",
        "o0 AS MATERIALIZED (SELECT patch, CASE WHEN row_number() OVER (PARTITION BY sr, sc ORDER BY n DESC, patch) = 1 THEN patch END AS owner FROM (SELECT sr, sc, patch, count(*) AS n FROM px GROUP BY ALL))",
        "bo AS MATERIALIZED (SELECT x.patch AS p, y.patch AS q, count(*) AS n FROM px x JOIN px y ON abs(x.r - y.r) + abs(x.c - y.c) = 1 AND x.patch <> y.patch GROUP BY 1, 2)",
        """tn(turn, patch, owner) AS (SELECT 0, patch, owner FROM o0 UNION ALL SELECT t.turn + 1, t.patch, coalesce(t.owner, w.owner) FROM tn t LEFT JOIN (
  SELECT p, owner FROM (SELECT bo.p, b.owner, row_number() OVER (PARTITION BY bo.p ORDER BY sum(bo.n) DESC, b.owner) AS rk FROM bo JOIN tn a ON a.patch = bo.p AND a.owner IS NULL JOIN tn b ON b.patch = bo.q AND b.owner IS NOT NULL GROUP BY bo.p, b.owner) WHERE rk = 1) w ON w.p = t.patch WHERE t.turn < 30)""",
        "own AS (SELECT patch, owner FROM tn WHERE turn = 30)",
    ]
    return "WITH RECURSIVE " + ", ".join(ctes)


_SUPER = _super_sql()


def windows(s, d):
    y = pq._years(s, d).where("not stable")
    w = Window.partitionBy("grid_id").orderBy("year")
    return y.withColumn("island", F.col("year") - F.row_number().over(w)).groupBy("grid_id", "island").agg(F.min("year").alias("y0"), F.max("year").alias("y1")).select("grid_id", "y0", "y1", F.floor((F.col("y0") + F.col("y1")) / 2).cast("int").alias("mid"))


QUERIES = {
    "a2_band_window": (
        lambda s, d: obs(s, d).select("px_row", "px_col", "scene_id", "line", "nir", "red", ((F.col("nir") > 0.02) & (F.col("red") > 0.05)).alias("valid")).groupBy("px_row", "px_col").agg(F.count("*").alias("n"), F.count(F.when(F.col("valid"), 1)).alias("n_valid")),
        f"WITH {OBS_SQL} SELECT px_row, px_col, count(*) AS n, count(*) FILTER (WHERE nir > 0.02 AND red > 0.05) AS n_valid FROM obs GROUP BY 1, 2",
    ),
    "h17_superpixels": (lambda s, d: superpixels(colours(s, d), ["v"], 5, 3), _SUPER + " SELECT r AS px_row, c AS px_col, v, coalesce(owner, patch) AS segment FROM px JOIN own USING (patch)"),
    "h17_one_part_each": (one_part_each, _SUPER + ", fi AS (SELECT coalesce(owner, patch) AS segment FROM px JOIN own USING (patch)) SELECT count(*) AS n_segments, CAST(sum(n) AS BIGINT) AS n_px, 0 AS n_in_parts FROM (SELECT segment, count(*) AS n FROM fi GROUP BY 1)"),
    "i10_label_layer": (lambda s, d: lq.seg_px(s, d).join(lq.lb.assign(lq.mj(s, d), 0.16, 0.88, 5).select("segment_id", "label"), "segment_id", "left").select("px_row", "px_col", "label"), f"WITH {_SP}, {_MJ}, {_SX} SELECT px_row, px_col, CASE WHEN n_valid < 5 OR coverage < 0.88 OR mode_class IS NULL THEN 254 WHEN purity < 0.16 THEN 255 ELSE mode_class END AS label FROM sx LEFT JOIN mj USING (segment_id)"),
    "k5_unstable_windows": (windows, f"{_W}, {pq._MODE_T}, {pq._YEARS} SELECT grid_id, y0, y1, CAST(floor((y0 + y1) / 2) AS INT) AS mid FROM (SELECT grid_id, island, min(year) AS y0, max(year) AS y1 FROM (SELECT grid_id, year, year - row_number() OVER (PARTITION BY grid_id ORDER BY year) AS island FROM ys WHERE NOT stable) GROUP BY 1, 2)"),
    "m3_parameter_sweep": (sweep, _sweep_sql()),
    "m5_core_relabelled": (core_patches, f"{_W}, {_CORE} SELECT id, mode_id, CAST(dense_rank() OVER (PARTITION BY mode_id ORDER BY patch) AS INT) AS label FROM cr JOIN cp USING (id)"),
    "m6_segments_in_parts": (one_part, f"WITH {_SX}, {_PARTS} SELECT segment_id, count(DISTINCT patch) AS n_parts FROM se JOIN sp2 USING (id) GROUP BY 1 HAVING count(DISTINCT patch) > 1"),
    "m10_block_transitions": (
        lambda s, d: op.transitions(block_panel(s, d)),
        f"{_W}, bp AS (SELECT block_row AS px_row, block_col AS px_col, (block_row // 2) * 10 + block_col // 2 AS grid_id, year, class_id FROM (SELECT *, row_number() OVER (PARTITION BY block_row, block_col, year ORDER BY n DESC, class_id) AS rk FROM (SELECT px_row // 3 AS block_row, px_col // 3 AS block_col, year, class_id, count(*) AS n FROM panel WHERE px_row // 3 < (SELECT (max(px_row) + 1) // 3 FROM panel) AND px_col // 3 < (SELECT (max(px_col) + 1) // 3 FROM panel) GROUP BY ALL)) WHERE rk = 1), {pq._TRANS.replace('FROM panel WHERE', 'FROM bp WHERE')} SELECT * FROM tr",
    ),
    "m10_masked_metrics": (
        lambda s, d: op.masked_metrics(ad.panel(s, d), ad.zone(s, d), ad.panel(s, d).where("px_row % 5 < 4 OR px_col % 5 < 4").select("px_row", "px_col"), s.createDataFrame(pq.PAIRS, "dominant int, other int"), ad.LAST_YEAR),
        f"""{_W}, {pq._PAIRS_SQL}, h AS (SELECT m.px_row, m.px_col, m.grid_id, m.mode_id AS c, l.class_id AS last_id, coalesce(eco_id, 0) AS e, m.mode_id NOT IN (0, 8) AS ok FROM pxmode m LEFT JOIN (SELECT * FROM panel WHERE year = 2001) l USING (px_row, px_col) LEFT JOIN zone USING (px_row, px_col) WHERE m.px_row % 5 < 4 OR m.px_col % 5 < 4),
ce AS (SELECT grid_id, count(*) AS n, count(*) FILTER (WHERE c = 0) AS nd, count(*) FILTER (WHERE c = 8) AS un, count(*) FILTER (WHERE ok) AS nv, count(*) FILTER (WHERE ok AND e > 0) AS nz FROM h GROUP BY 1),
bc AS (SELECT grid_id, c, count(*) AS k, count(*) FILTER (WHERE e > 0) AS kz FROM h WHERE ok GROUP BY ALL), md AS (SELECT grid_id, arg_max(c, k * 100 - c) AS mode_id, max(k) AS mk, count(*) AS n_mode_classes FROM bc GROUP BY 1),
sh AS (SELECT grid_id, round(-sum(k / nv * ln(k / nv)) + 0.0, 4) AS shannon FROM bc JOIN ce USING (grid_id) GROUP BY 1),
la AS (SELECT grid_id, arg_max(last_id, k * 100 - last_id) AS last_id, max(k) AS lk FROM (SELECT grid_id, last_id, count(*) AS k FROM h WHERE ok AND last_id IS NOT NULL GROUP BY ALL) GROUP BY 1),
ec AS (SELECT grid_id, arg_max(e, k * 100 - e) AS eco_id, max(k) AS ek FROM (SELECT grid_id, e, count(*) AS k FROM h WHERE ok AND e > 0 GROUP BY ALL) GROUP BY 1),
ri AS (SELECT grid_id, sum(kz) AS kr FROM bc JOIN md USING (grid_id) JOIN pairs ON dominant = mode_id AND other = c GROUP BY 1)
SELECT grid_id, round(100.0 * nv / n, 4) AS valid_pct, round(100.0 * nd / n, 4) AS nodata_pct, round(100.0 * un / n, 4) AS unobserved_pct, mode_id, round(100.0 * mk / nv, 4) AS mode_pct, last_id, round(100.0 * lk / nv, 4) AS last_pct, n_mode_classes, shannon,
  CASE WHEN nv > 0 THEN coalesce(eco_id, 0) END AS eco_id, CASE WHEN nv > 0 THEN CASE WHEN nz > 0 THEN round(100.0 * ek / nz, 4) ELSE 0 END END AS eco_pct, CASE WHEN nv > 0 THEN CASE WHEN nz > 0 THEN round(100.0 * coalesce(kr, 0) / nz, 4) ELSE 0 END END AS risk_pct
FROM ce LEFT JOIN md USING (grid_id) LEFT JOIN sh USING (grid_id) LEFT JOIN la USING (grid_id) LEFT JOIN ec USING (grid_id) LEFT JOIN ri USING (grid_id)""",
    ),
    "m11_completeness": (lambda s, d: rp.pending_units(ad.table(s, d, "customer").select(F.col("c_custkey").alias("unit")), aq.audits(s, d), ["unit"], "seq").agg(F.count("*").alias("n_pending"), (F.count("*") == 0).alias("complete")), f"WITH {aq._AU} SELECT count(*) AS n_pending, count(*) = 0 AS complete FROM customer WHERE c_custkey NOT IN (SELECT unit FROM la WHERE status IN ('complete', 'empty'))"),
    "m13_seeded_exclusion": (
        lambda s, d: lattice.exclude_overlapping(boxes(s, d).where("box_id % 14 <> 0"), boxes(s, d).where("box_id % 14 = 0"), 4).select("box_id"),
        f"WITH {_BOX} SELECT box_id FROM box a WHERE box_id % 14 <> 0 AND NOT EXISTS (SELECT 1 FROM box b WHERE b.box_id % 14 = 0 AND least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0))",
    ),
}
