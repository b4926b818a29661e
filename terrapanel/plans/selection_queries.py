"""Selection, allocation, component and region queries over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrapanel.operators import graph, lattice
from terrapanel.operators import panel as op
from terrapanel.operators import selection as sel
from terrapanel.plans import panel_queries as pq
from terrapanel.plans.grid_queries import _BOX, _PAIR, boxes
from terrapanel.sources import adapters as ad

_W = "WITH " + ad.SQL
_MIX = "(box_id * 2654435761 + 17) % 4294967296"


def metrics(s, d):
    return pq.c19(s, d).na.fill(0)


_M = f"{pq._C19}, mt AS (SELECT grid_id, CAST(total AS BIGINT) AS total, round(100.0 * (total - nd - un) / total, 4) AS valid_pct, coalesce(round(100.0 * d.ha / d.whole, 4), 0) AS dominant_pct, coalesce(d.n, 0) AS n_classes, coalesce(d.class_id, 0) AS dominant_class_id, coalesce(round(h + 0.0, 4), 0) AS shannon, coalesce(eco_id, 0) AS eco, coalesce(transition_pct, 0) AS transition_pct, coalesce(max_run, 0) AS max_run {pq._C19_FROM})"

POOLS = {
    "stable_homogeneous": "max_run >= 3 AND dominant_pct >= 40", "stable_simple": "max_run >= 3 AND n_classes <= 5", "annual_homogeneous": "max_run < 3 AND dominant_pct >= 40",
    "annual_simple": "max_run < 3 AND n_classes <= 6", "transition_homogeneous": "transition_pct >= 60 AND dominant_pct >= 30", "transition_simple": "transition_pct >= 60 AND n_classes <= 6",
}


def scores(s, d):
    m = metrics(s, d)
    base = F.col("valid_pct") / 100 * 2 + 1
    norm = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("shannon") / F.log(F.lit(7.0))))
    few = F.greatest(F.lit(2), F.least(F.lit(4), F.col("n_classes"))) / 4
    return m.select(
        "grid_id",
        F.round(F.col("max_run") / 7 * 5 + F.col("dominant_pct") / 100 * 3 + (1 - norm) * 2 + base, 3).alias("stable_homogeneous"),
        F.round(F.col("max_run") / 7 * 4 + F.col("dominant_pct") / 100 * 3 + few * 2 + base, 3).alias("stable_simple"),
        F.round(F.col("transition_pct") / 100 * 5 + F.col("dominant_pct") / 100 * 4 + base, 3).alias("transition_homogeneous"),
        F.round(F.col("transition_pct") / 100 * 5 + few * 3 + base, 3).alias("transition_simple"),
    )


def annual(s, d):
    p = op.period_summary(ad.panel(s, d), ad.periods(s), pq._years(s, d))
    arr = p.groupBy("grid_id").agg(F.array_sort(F.collect_list(F.struct("period", "md_pct", "n_stable"))).alias("ps"))
    good = F.filter("ps", lambda x: x["md_pct"] >= 30)
    return arr.select("grid_id", F.round(F.array_max(F.transform("ps", lambda x: x["md_pct"] / 100 * 6 + x["n_stable"] / 2)), 4).alias("score"), F.array_max(F.transform(good, lambda x: x["md_pct"])).alias("best_pct"), F.try_element_at(F.reverse(F.transform(good, lambda x: x["period"])), F.lit(1)).alias("latest"))


_PS = pq.QUERIES["c13_period_summary"][1].rsplit("SELECT grid_id, period, class_id AS md_id", 1)
_PS_SQL = _PS[0] + ", ps AS (SELECT grid_id, period, class_id AS md_id" + _PS[1] + ")"


def conflicts(s, d):
    b = boxes(s, d)
    return lattice.overlaps(b, b, 4, True).where("area > 0").select("a", "b")


def greedy(s, d):
    ranked = boxes(s, d).select(F.col("box_id").alias("id"), F.expr(_MIX).alias("rank"))
    return sel.independent_prefix(ranked, conflicts(s, d))


def matrix(s, d):
    """Hectares of each class in each zone."""
    m = op.temporal_mode(ad.panel(s, d)).join(ad.zone(s, d).where("eco_id > 0"), ["px_row", "px_col"]).where("mode_id not in (0, 8)")
    return m.groupBy("eco_id", F.col("mode_id").alias("class_id")).agg(F.sum("area").alias("ha"))


_MX = "mx AS (SELECT eco_id, mode_id AS class_id, CAST(sum(area) AS BIGINT) AS ha FROM pxmode JOIN zone USING (px_row, px_col) WHERE eco_id > 0 AND mode_id NOT IN (0, 8) GROUP BY ALL)"


def px3(s, d, values="mode_id in (1, 2, 3, 4)"):
    return op.temporal_mode(ad.panel(s, d)).where(values).select(F.expr("px_row * 50 + px_col").alias("id"), "px_row", "px_col", "area", "mode_id")


def cluster_cells(s, d):
    return metrics(s, d).where("n_classes <= 7").select(F.col("grid_id").alias("cell_id"), F.expr("CAST(grid_id DIV 10 AS INT)").alias("row_idx"), (F.col("grid_id") % 10).cast("int").alias("col_idx"), F.when(F.col("grid_id") % 3 == 0, "val").when(F.col("grid_id") % 7 == 0, "test").otherwise("train").alias("split"))


_CL = """cl AS (SELECT grid_id AS cell_id, CAST(grid_id // 10 AS INT) AS r, CAST(grid_id % 10 AS INT) AS c, CASE WHEN grid_id % 3 = 0 THEN 'val' WHEN grid_id % 7 = 0 THEN 'test' ELSE 'train' END AS split FROM mt WHERE n_classes <= 7),
nb AS (SELECT a.cell_id AS a, b.cell_id AS b, a.split AS sa, b.split AS sb FROM cl a JOIN cl b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND a.cell_id <> b.cell_id)"""
_CC = """cc AS (WITH RECURSIVE walk(node, root) AS (SELECT cell_id, cell_id FROM cl UNION SELECT nb.b, walk.root FROM walk JOIN nb ON nb.a = walk.node) SELECT node AS cell_id, min(root) AS cluster FROM walk GROUP BY node)"""


def quota(s, d):
    return matrix(s, d).withColumn("avail", F.col("ha") % 40 + 1)


_PATCH_SQL = """p3 AS (SELECT px_row * 50 + px_col AS id, px_row, px_col, area, mode_id FROM pxmode WHERE mode_id IN (1, 2, 3, 4)),
e3 AS (SELECT a.id AS a, b.id AS b FROM p3 a JOIN p3 b ON a.mode_id = b.mode_id AND abs(a.px_row - b.px_row) + abs(a.px_col - b.px_col) = 1),
pt AS (WITH RECURSIVE walk(node, root) AS (SELECT id, id FROM p3 UNION SELECT e3.b, walk.root FROM walk JOIN e3 ON e3.a = walk.node) SELECT node AS id, min(root) AS patch FROM walk GROUP BY node)"""


def segments(s, d):
    """Pixels with a segment each, and integer bands."""
    t = ad.table(s, d, "lineitem")
    return t.groupBy(*ad.pixel("l_partkey")).agg((F.min("l_suppkey") % 40).alias("segment_id"), F.sum(F.col("l_quantity").cast("int")).alias("b1"), F.sum("l_linenumber").alias("b2"))


_SEG = "seg AS (SELECT CAST(l_partkey // 50 AS INT) AS px_row, CAST(l_partkey % 50 AS INT) AS px_col, min(l_suppkey) % 40 AS segment_id, sum(CAST(l_quantity AS INT)) AS b1, sum(l_linenumber) AS b2 FROM lineitem GROUP BY 1, 2), nd AS (SELECT segment_id, count(*) AS n, avg(b1) AS b1, avg(b2) AS b2 FROM seg GROUP BY 1), ed AS (SELECT DISTINCT least(p.segment_id, q.segment_id) AS a, greatest(p.segment_id, q.segment_id) AS b FROM seg p JOIN seg q ON abs(p.px_row - q.px_row) + abs(p.px_col - q.px_col) = 1 AND p.segment_id <> q.segment_id), ew AS (SELECT a, b, sqrt(pow(x.b1 - y.b1, 2) + pow(x.b2 - y.b2, 2)) AS weight FROM ed JOIN nd x ON x.segment_id = a JOIN nd y ON y.segment_id = b)"


def h14(s, d):
    nodes, edges = graph.region_graph(segments(s, d), "segment_id", ["b1", "b2"])
    return graph.cut_and_merge(nodes, edges, "segment_id", 0.05)


_SIEVED = f"{_W}, {_PATCH_SQL}, q AS (SELECT p3.*, patch FROM p3 JOIN pt USING (id)), sz AS (SELECT patch, count(*) AS n, min(mode_id) AS v FROM q GROUP BY 1), tc AS (SELECT DISTINCT a.patch AS p, b.patch AS q FROM q a JOIN q b ON abs(a.px_row - b.px_row) + abs(a.px_col - b.px_col) = 1 AND a.patch <> b.patch), bs AS (SELECT p, v AS new FROM (SELECT p, sz.v, row_number() OVER (PARTITION BY p ORDER BY sz.n DESC, q) AS rk FROM tc JOIN sz ON sz.patch = q WHERE (SELECT n FROM sz s2 WHERE s2.patch = p) < 3) WHERE rk = 1) SELECT id, mode_id AS old, coalesce(new, mode_id) AS new FROM q LEFT JOIN bs ON p = patch"
#: The first of three rows picks by its key, the second of the two years left, the third takes the last.
_BALANCED = f"""{_M}, rk AS (SELECT eco, CAST(grid_id AS BIGINT) AS k, row_number() OVER (PARTITION BY eco ORDER BY dominant_pct, grid_id) - 1 AS place FROM mt),
r1 AS (SELECT eco, place // 3 AS run, k, [1996, 1998, 2000][k % 3 + 1] AS y FROM rk WHERE place % 3 = 0),
r2 AS (SELECT rk.eco, place // 3 AS run, rk.k, y AS y1, list_filter([1996, 1998, 2000], lambda x: x <> y)[rk.k % 2 + 1] AS y FROM rk JOIN r1 ON rk.eco = r1.eco AND place // 3 = run WHERE place % 3 = 1),
r3 AS (SELECT rk.eco, rk.k, 5994 - y1 - y AS y FROM rk JOIN r2 ON rk.eco = r2.eco AND place // 3 = run WHERE place % 3 = 2)
SELECT eco AS dominant_eco_id, k, CAST(y AS INT) AS ref_year FROM (SELECT eco, k, y FROM r1 UNION ALL SELECT eco, k, y FROM r2 UNION ALL SELECT eco, k, y FROM r3)"""
#: The highest level that the quotas reach together, and one more for the first of those that have more.
_LEVELS = f"""{_W}, {_MX}, av AS (SELECT *, ha % 40 + 1 AS avail FROM mx), lv AS (SELECT eco_id, max(l) AS l FROM (SELECT eco_id, l, sum(least(avail, l)) AS used FROM av, (SELECT unnest(range(0, 61)) AS l) GROUP BY 1, 2) WHERE used <= 60 GROUP BY 1),
us AS (SELECT eco_id, l, 60 - sum(least(avail, l)) AS spare FROM av JOIN lv USING (eco_id) GROUP BY 1, 2)
SELECT eco_id, class_id, ha, avail, CAST(least(avail, l) + CASE WHEN avail > l AND row_number() OVER (PARTITION BY eco_id, avail > l ORDER BY avail, class_id) <= spare THEN 1 ELSE 0 END AS BIGINT) AS quota FROM av JOIN us USING (eco_id)"""
#: One box after the other in order, with a list of those taken.
_GREEDY = f"""WITH RECURSIVE {_BOX}, {_PAIR}, cf AS (SELECT id, list(other) AS others FROM (SELECT a AS id, b AS other FROM pr WHERE area > 0 UNION ALL SELECT b, a FROM pr WHERE area > 0) GROUP BY 1),
od AS (SELECT box_id AS id, {_MIX} AS rank, coalesce(others, []) AS others, row_number() OVER (ORDER BY {_MIX}) AS k FROM box LEFT JOIN cf ON id = box_id),
go(k, taken, last) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT UNION ALL SELECT od.k, CASE WHEN list_has_any(others, taken) THEN taken ELSE list_append(taken, id) END, CASE WHEN list_has_any(others, taken) THEN NULL ELSE id END FROM go JOIN od ON od.k = go.k + 1)
SELECT id, rank FROM od WHERE id IN (SELECT last FROM go)"""

#: All pixels round by round: what the settled ones around say, and at the end the nearest settled one.
_ROUNDS = f"""WITH RECURSIVE {ad.SQL}, p AS (SELECT px_row * 50 + px_col AS id, px_row, px_col, mode_id FROM pxmode WHERE mode_id > 0),
e AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.mode_id = b.mode_id AND abs(a.px_row - b.px_row) <= 1 AND abs(a.px_col - b.px_col) <= 1),
walk(node, root) AS (SELECT id, id FROM p UNION SELECT e.b, walk.root FROM walk JOIN e ON e.a = walk.node), pt AS (SELECT node AS id, min(root) AS patch FROM walk GROUP BY node),
st(turn, id, r, c, old, now, ok) AS (
  SELECT 0, id, px_row, px_col, mode_id, mode_id, count(*) OVER (PARTITION BY patch) >= 3 FROM p JOIN pt USING (id)
  UNION ALL
  SELECT s.turn + 1, s.id, s.r, s.c, s.old, coalesce(v.vote, s.now), s.ok OR v.vote IS NOT NULL FROM st s LEFT JOIN (
    SELECT id, vote FROM (SELECT a.id, b.now AS vote, row_number() OVER (PARTITION BY a.id ORDER BY count(*) DESC, b.now) AS rk FROM st a JOIN st b ON NOT a.ok AND b.ok AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY a.id, b.now) WHERE rk = 1) v ON v.id = s.id WHERE s.turn < 50),
fin AS (SELECT * FROM st WHERE turn = 50),
nr AS (SELECT id, vote FROM (SELECT a.id, b.now AS vote, row_number() OVER (PARTITION BY a.id ORDER BY (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c), b.r, b.c) AS rk FROM fin a JOIN fin b ON NOT a.ok AND b.ok) WHERE rk = 1)
SELECT id, r AS px_row, c AS px_col, old, coalesce(vote, now) AS new, ok OR vote IS NOT NULL AS resolved FROM fin LEFT JOIN nr USING (id)"""

QUERIES = {
    "d1_quality_filter": (
        lambda s, d: metrics(s, d).join(F.broadcast(s.createDataFrame([(k, 60.0 + k) for k in range(6)], "eco int, least double")), F.col("dominant_eco_id") == F.col("eco"), "left").where("valid_pct >= coalesce(least, 70)").select("grid_id", "valid_pct"),
        f"{_M} SELECT grid_id, valid_pct FROM mt WHERE valid_pct >= 60.0 + eco",
    ),
    "d2_failure_counts": (
        lambda s, d: sel.failure_counts(metrics(s, d), {"valid": F.col("valid_pct") >= 75, "pure": F.col("dominant_pct") >= 35, "few": F.col("n_classes") <= 6}, ["dominant_eco_id"]),
        f"{_M} SELECT eco AS dominant_eco_id, count(*) AS n, count(*) FILTER (WHERE valid_pct < 75) AS fails_valid, count(*) FILTER (WHERE dominant_pct < 35) AS fails_pure, count(*) FILTER (WHERE n_classes > 6) AS fails_few, count(*) FILTER (WHERE valid_pct >= 75 AND dominant_pct >= 35 AND n_classes <= 6) AS n_pass FROM mt GROUP BY eco",
    ),
    "d3_pools": (lambda s, d: sel.pools(metrics(s, d), {k: F.expr(c) for k, c in POOLS.items()}).select("grid_id", "pool"), f"{_M} " + " UNION ALL ".join(f"SELECT grid_id, '{k}' AS pool FROM mt WHERE {c}" for k, c in POOLS.items())),
    "d4_arid_transition": (
        lambda s, d: metrics(s, d).where((F.col("transition_pct") >= 50) & (F.greatest("dominant_pct", F.col("valid_pct") / 2) >= 40) | F.col("dominant_class_id").isin(2, 5)).select("grid_id"),
        f"{_M} SELECT grid_id FROM mt WHERE (transition_pct >= 50 AND greatest(dominant_pct, valid_pct / 2) >= 40) OR dominant_class_id IN (2, 5)",
    ),
    "d5_model_flags": (
        lambda s, d: metrics(s, d).select("grid_id", F.col("dominant_class_id").isin(4, 5).alias("crosscut_mode"), (F.col("dominant_class_id").isin(1, 2, 3) | (F.col("dominant_pct") < 30)).alias("general_ok")),
        f"{_M} SELECT grid_id, dominant_class_id IN (4, 5) AS crosscut_mode, dominant_class_id IN (1, 2, 3) OR dominant_pct < 30 AS general_ok FROM mt",
    ),
    "d6_block_classes": (lambda s, d: metrics(s, d).where(~((F.col("dominant_class_id") == 6) & ~((F.col("shannon") > 1.5) | (F.col("dominant_eco_id") == 3)))).select("grid_id"), f"{_M} SELECT grid_id FROM mt WHERE NOT (dominant_class_id = 6 AND NOT (shannon > 1.5 OR eco = 3))"),
    "d7_presence_by_area": (lambda s, d: metrics(s, d).join(op.area_by_class(op.temporal_mode(ad.panel(s, d))).where("class_id = 3 and ha >= 300"), "grid_id", "left_semi").select("grid_id"), f"{_W} SELECT grid_id FROM cell_class WHERE class_id = 3 AND ha >= 300"),
    "d8_presence_strength": (
        lambda s, d: metrics(s, d).join(op.best_period_share(ad.panel(s, d), op.temporal_mode(ad.panel(s, d)), ad.periods(s)).where("class_id = 3").select("grid_id", "pctp"), "grid_id", "left").select("grid_id", F.greatest(F.coalesce("pctp", F.lit(0.0)), F.when(F.col("dominant_class_id") == 3, F.col("dominant_pct")).otherwise(0.0)).alias("strength")),
        pq.QUERIES["c5_best_period_share"][1].rsplit("SELECT grid_id, class_id, max(pct)", 1)[0] + ", bp AS (SELECT grid_id, class_id, max(pct)" + pq.QUERIES["c5_best_period_share"][1].rsplit("SELECT grid_id, class_id, max(pct)", 1)[1] + f"), {pq._DOM}, g AS (SELECT DISTINCT grid_id FROM panel) SELECT grid_id, greatest(coalesce(pctp, 0.0), CASE WHEN d.class_id = 3 THEN round(100.0 * d.ha / d.whole, 4) ELSE 0 END) AS strength FROM g LEFT JOIN (SELECT * FROM bp WHERE class_id = 3) b USING (grid_id) LEFT JOIN (SELECT * FROM dom WHERE rk = 1) d USING (grid_id)",
    ),
    "e1_typological_scores": (
        scores,
        f"{_M} SELECT grid_id, round(max_run / 7 * 5 + dominant_pct / 100 * 3 + (1 - greatest(0.0, least(1.0, shannon / ln(7.0)))) * 2 + valid_pct / 100 * 2 + 1, 3) AS stable_homogeneous, round(max_run / 7 * 4 + dominant_pct / 100 * 3 + greatest(2, least(4, n_classes)) / 4 * 2 + valid_pct / 100 * 2 + 1, 3) AS stable_simple, round(transition_pct / 100 * 5 + dominant_pct / 100 * 4 + valid_pct / 100 * 2 + 1, 3) AS transition_homogeneous, round(transition_pct / 100 * 5 + greatest(2, least(4, n_classes)) / 4 * 3 + valid_pct / 100 * 2 + 1, 3) AS transition_simple FROM mt",
    ),
    "e2_annual_score": (annual, f"{_PS_SQL} SELECT grid_id, round(max(md_pct / 100 * 6 + n_stable / 2), 4) AS score, max(md_pct) FILTER (WHERE md_pct >= 30) AS best_pct, max(period) FILTER (WHERE md_pct >= 30) AS latest FROM ps GROUP BY grid_id"),
    "e4_balanced_years": (lambda s, d: sel.balanced_years(metrics(s, d).withColumn("k", F.col("grid_id").cast("long")), ["dominant_eco_id"], ["dominant_pct"], [1996, 1998, 2000], "k"), _BALANCED),
    "e5_segment_quota": (
        lambda s, d: matrix(s, d).select("eco_id", "class_id", F.round(F.col("ha") * 50 / 1000.0, 4).alias("segments"), F.greatest(F.lit(1), F.bround(F.col("ha") * 50 / 1000.0 / 4.5, 0)).cast("long").alias("rects")),
        f"{_W}, {_MX} SELECT eco_id, class_id, round(ha * 50 / 1000.0, 4) AS segments, CAST(greatest(1, round_even(ha * 50 / 1000.0 / 4.5, 0)) AS BIGINT) AS rects FROM mx",
    ),
    "g1_treatment_mode": (
        lambda s, d: sel.top_per_group(matrix(s, d), ["eco_id"], [F.desc("ha"), F.col("class_id")], 10**9).withColumn("pct", F.round(100.0 * F.col("ha") / F.sum("ha").over(Window.partitionBy("eco_id")), 4)).select("eco_id", "class_id", "pct", F.when((F.col("eco_id") == 1) & (F.col("class_id") == 3), "reinforcement").when(F.col("ha") <= 100, "census").when(F.col("pct") < 10, "reinforcement").when(F.col("rank") == 1, "ceiling").otherwise("standard").alias("mode")),
        f"{_W}, {_MX} SELECT eco_id, class_id, pct, CASE WHEN eco_id = 1 AND class_id = 3 THEN 'reinforcement' WHEN ha <= 100 THEN 'census' WHEN pct < 10 THEN 'reinforcement' WHEN rk = 1 THEN 'ceiling' ELSE 'standard' END AS mode FROM (SELECT *, round(100.0 * ha / sum(ha) OVER (PARTITION BY eco_id), 4) AS pct, row_number() OVER (PARTITION BY eco_id ORDER BY ha DESC, class_id) AS rk FROM mx)",
    ),
    "g2_coverage_need": (
        lambda s, d: sel.coverage_need(op.area_by_class(op.temporal_mode(ad.panel(s, d))), ["class_id"], [F.desc("ha"), F.col("grid_id")], "ha", 0.8),
        f"{_W} SELECT class_id, min(rk) AS n_needed FROM (SELECT class_id, row_number() OVER w AS rk, sum(ha) OVER (PARTITION BY class_id ORDER BY ha DESC, grid_id ROWS UNBOUNDED PRECEDING) AS upto, sum(ha) OVER (PARTITION BY class_id) AS whole FROM cell_class WINDOW w AS (PARTITION BY class_id ORDER BY ha DESC, grid_id)) WHERE upto >= 0.8 * whole GROUP BY class_id",
    ),
    "g3_budget": (
        lambda s, d: sel.budget(matrix(s, d).groupBy("eco_id").agg(F.sum(F.pow("class_id", 3) * F.col("ha")).alias("score")), 1000, 190).select("eco_id", "budget"),
        f"{_W}, {_MX}, z AS (SELECT eco_id, sum(pow(class_id, 3) * ha) AS score FROM mx GROUP BY 1), r AS (SELECT *, floor(1000 * score / sum(score) OVER ()) < 190 AS low FROM z) SELECT eco_id, CAST(CASE WHEN low THEN 190 ELSE greatest(190, floor((1000 - 190 * sum(CASE WHEN low THEN 1 ELSE 0 END) OVER ()) * score / sum(CASE WHEN NOT low THEN score END) OVER ())) END AS BIGINT) AS budget FROM r",
    ),
    "g4_zone_thresholds": (
        lambda s, d: metrics(s, d).groupBy("dominant_eco_id").agg(F.percentile("transition_pct", F.array(F.lit(0.25), F.lit(0.75))).alias("p")).select("dominant_eco_id", F.round(F.greatest(F.lit(20.0), F.col("p")[0]), 4).alias("low"), F.round(F.least(F.lit(90.0), F.col("p")[1]), 4).alias("high")),
        f"{_M} SELECT eco AS dominant_eco_id, round(greatest(20.0, quantile_cont(transition_pct, 0.25)), 4) AS low, round(least(90.0, quantile_cont(transition_pct, 0.75)), 4) AS high FROM mt GROUP BY eco",
    ),
    "g5_top_per_group": (lambda s, d: sel.top_per_group(metrics(s, d).select("grid_id", "dominant_eco_id", "shannon"), ["dominant_eco_id"], [F.desc("shannon"), F.col("grid_id")], 3), f"{_M} SELECT * FROM (SELECT grid_id, eco AS dominant_eco_id, shannon, CAST(row_number() OVER (PARTITION BY eco ORDER BY shannon DESC, grid_id) AS INT) AS rank FROM mt) WHERE rank <= 3"),
    "g6_round_robin": (lambda s, d: sel.round_robin(metrics(s, d).select("grid_id", "dominant_eco_id", "shannon"), "dominant_eco_id", [F.desc("shannon"), F.col("grid_id")]), f"{_M} SELECT grid_id, eco AS dominant_eco_id, shannon, CAST(row_number() OVER (PARTITION BY eco ORDER BY shannon DESC, grid_id) AS INT) AS turn FROM mt"),
    "g7_greedy_non_overlapping": (greedy, _GREEDY),
    "g8_pick_until_covered": (
        lambda s, d: sel.prefix_until(op.area_by_class(op.temporal_mode(ad.panel(s, d))), ["class_id"], [F.desc("ha"), F.col("grid_id")], "ha", F.lit(2000), 5),
        f"{_W} SELECT * FROM (SELECT grid_id, class_id, CAST(ha AS BIGINT) AS ha, CAST(row_number() OVER (PARTITION BY class_id ORDER BY ha DESC, grid_id) AS INT) AS rank, CAST(coalesce(sum(ha) OVER (PARTITION BY class_id ORDER BY ha DESC, grid_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM cell_class) WHERE before < 2000 AND rank <= 5",
    ),
    "g13_cap_per_class": (
        lambda s, d: sel.cap_per_value(metrics(s, d), "dominant_class_id", F.col("shannon") > 1.9, [F.desc("shannon"), F.col("grid_id")], 0.05).select("grid_id", "dominant_class_id"),
        f"{_M} SELECT grid_id, dominant_class_id FROM (SELECT *, row_number() OVER (PARTITION BY dominant_class_id ORDER BY shannon > 1.9 DESC, shannon DESC, grid_id) AS rk FROM mt) WHERE shannon > 1.9 OR rk <= greatest(1, CAST(floor((SELECT count(*) FROM mt) * 0.05) AS INT))",
    ),
    "g17_largest_remainder": (
        lambda s, d: sel.largest_remainder(matrix(s, d), ["eco_id"], "ha", 97, "class_id"),
        f"{_W}, {_MX} SELECT eco_id, class_id, ha, CAST(w + CASE WHEN row_number() OVER (PARTITION BY eco_id ORDER BY round(x - w, 9) DESC, class_id) <= 97 - sum(w) OVER (PARTITION BY eco_id) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM (SELECT *, floor(x) AS w FROM (SELECT *, 97 * ha / sum(ha) OVER (PARTITION BY eco_id) AS x FROM mx))",
    ),
    "g18_capped_equal": (lambda s, d: sel.capped_equal(quota(s, d), ["eco_id"], "avail", 60, "class_id"), _LEVELS),
    "g21_seeded_shuffle": (
        lambda s, d: boxes(s, d).orderBy(F.expr(_MIX), "box_id").limit(20).select("box_id", F.row_number().over(Window.orderBy(F.expr(_MIX), "box_id")).alias("rank")),
        f"WITH {_BOX} SELECT * FROM (SELECT box_id, CAST(row_number() OVER (ORDER BY {_MIX}, box_id) AS INT) AS rank FROM box) WHERE rank <= 20",
    ),
    "h1_clusters": (lambda s, d: graph.clusters(cluster_cells(s, d)).select("cell_id", "cluster"), f"{_M}, {_CL}, {_CC} SELECT * FROM cc"),
    "h2_split_by_cluster": (
        lambda s, d: sel.split_by_cluster(graph.clusters(cluster_cells(s, d)).withColumn("g", F.col("cell_id") % 2), ["g"], "cluster", F.expr("(cluster * 2654435761 + 5) % 4294967296")),
        f"{_M}, {_CL}, {_CC}, u AS (SELECT DISTINCT cell_id % 2 AS g, cluster FROM cc), v AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY (cluster * 2654435761 + 5) % 4294967296, cluster) AS place, count(*) OVER (PARTITION BY g) AS n FROM u), t AS (SELECT *, least(greatest(1, floor(n * 0.7 + 0.5)), CASE WHEN n >= 3 THEN n - 2 WHEN n = 2 THEN 1 ELSE n END) AS tr, greatest(CASE WHEN n >= 2 THEN 1 ELSE 0 END, floor(n * 0.15 + 0.5)) AS va FROM v) SELECT g, cluster, CASE WHEN place <= tr THEN 'train' WHEN place <= tr + va THEN 'val' ELSE 'test' END AS split FROM t",
    ),
    "h4_split_feasible": (
        lambda s, d: graph.clusters(cluster_cells(s, d)).groupBy((F.col("cell_id") % 3).alias("zone_id")).agg(F.count_distinct("cluster").alias("n_clusters"), F.count_distinct(F.when(F.col("split") == "val", F.col("cluster"))).alias("n_val"), (F.avg((F.col("split") == "train").cast("int")) >= 0.5).alias("train_ok")),
        f"{_M}, {_CL}, {_CC} SELECT cell_id % 3 AS zone_id, count(DISTINCT cluster) AS n_clusters, count(DISTINCT CASE WHEN split = 'val' THEN cluster END) AS n_val, avg(CASE WHEN split = 'train' THEN 1.0 ELSE 0.0 END) >= 0.5 AS train_ok FROM cl JOIN cc USING (cell_id) GROUP BY 1",
    ),
    "h5_leaks": (lambda s, d: graph.leaks(cluster_cells(s, d)), f"{_M}, {_CL} SELECT count(*) AS neighbor_pairs, CAST(coalesce(sum(CASE WHEN sa <> sb THEN 1 ELSE 0 END), 0) // 2 AS BIGINT) AS leaks FROM nb"),
    "h6_repair_leaks": (lambda s, d: graph.repair_leaks(cluster_cells(s, d)).select("cell_id", "split"), f"{_M}, {_CL}, {_CC} SELECT cell_id, CASE WHEN count(*) OVER (PARTITION BY cluster) > 1 AND min(split) OVER (PARTITION BY cluster) <> max(split) OVER (PARTITION BY cluster) THEN 'train' ELSE split END AS split FROM cl JOIN cc USING (cell_id)"),
    "h7_patches": (lambda s, d: graph.patches(px3(s, d), "mode_id").select("id", "patch"), f"{_W}, {_PATCH_SQL} SELECT * FROM pt"),
    "h8_patch_sizes": (
        lambda s, d: graph.size_distribution(graph.patch_table(graph.patches(px3(s, d), "mode_id"), "mode_id"), ["mode_id"], 3),
        f"{_W}, {_PATCH_SQL}, ps AS (SELECT patch, mode_id, count(*) AS n_px, sum(area) AS ha FROM p3 JOIN pt USING (id) GROUP BY 1, 2) SELECT mode_id, count(*) AS n, CAST(sum(ha) AS BIGINT) AS ha, quantile_cont(n_px, 0.5) AS p50, quantile_cont(n_px, 0.9) AS p90, max(n_px) AS largest, round(100.0 * avg(CASE WHEN n_px < 3 THEN 1.0 ELSE 0.0 END), 4) AS small_pct FROM ps GROUP BY 1",
    ),
    "h9_sieve": (lambda s, d: graph.sieve(px3(s, d, "mode_id > 0"), "mode_id", 3), _ROUNDS),
    "h10_sieve_into_largest": (lambda s, d: graph.sieve_into_largest(px3(s, d), "mode_id", 3), _SIEVED),
    "h11_sieve_changes": (lambda s, d: graph.sieve_into_largest(px3(s, d), "mode_id", 3).groupBy("old", "new").agg(F.count("*").alias("n")), f"SELECT old, new, count(*) AS n FROM ({_SIEVED}) GROUP BY 1, 2"),
    "h12_patch_table": (
        lambda s, d: graph.patch_table(graph.patches(px3(s, d), "mode_id"), "mode_id"),
        f"{_W}, {_PATCH_SQL} SELECT patch, mode_id, count(*) AS n_px, CAST(sum(area) AS BIGINT) AS ha, min(px_row) AS row0, max(px_row) AS row1, min(px_col) AS col0, max(px_col) AS col1 FROM p3 JOIN pt USING (id) GROUP BY 1, 2",
    ),
    "h13_region_graph": (lambda s, d: graph.region_graph(segments(s, d), "segment_id", ["b1", "b2"])[1].withColumn("weight", F.round("weight", 4)), f"WITH {_SEG} SELECT a, b, round(weight, 4) AS weight FROM ew"),
    "h14_cut_and_merge": (
        h14,
        f"WITH RECURSIVE {_SEG}, lk AS (SELECT a, b FROM ew WHERE weight < (SELECT quantile_cont(weight, 0.05) FROM ew) UNION SELECT b, a FROM ew WHERE weight < (SELECT quantile_cont(weight, 0.05) FROM ew)), walk(node, root) AS (SELECT segment_id, segment_id FROM nd UNION SELECT lk.b, walk.root FROM walk JOIN lk ON lk.a = walk.node) SELECT node AS segment_id, min(root) AS merged FROM walk GROUP BY node",
    ),
    "h18_segment_sizes": (lambda s, d: segments(s, d).groupBy("segment_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("n_segments"), F.round(F.avg("n"), 4).alias("mean"), F.median("n").alias("median"), F.min("n").alias("least"), F.max("n").alias("most")), f"WITH {_SEG} SELECT count(*) AS n_segments, round(avg(n), 4) AS mean, median(n) AS median, min(n) AS least, max(n) AS most FROM nd"),
}
