"""Further selection, label and report queries over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrapanel.functions import indices as ix
from terrapanel.operators import graph, labels, merging, selection
from terrapanel.operators import lattice as lat
from terrapanel.operators import panel as op
from terrapanel.operators import reviewplan as rp
from terrapanel.plans import audit_queries as aq
from terrapanel.plans import label_queries as lq
from terrapanel.plans import panel_queries as pq
from terrapanel.plans import selection_queries as sq
from terrapanel.plans.grid_queries import _BANDS, _BOX, _PT, OBS_SQL, boxes, geodesic_sql, obs, points
from terrapanel.plans.label_queries import _MJ, _PQ, _SP, patches
from terrapanel.sources import adapters as ad
from terrapanel.sources import tables as tb
from terrapanel.sources.shared import shared_dir

_W = "WITH " + ad.SQL
_M = sq._M
#: Three levels of names for the classes of the adapters.
TAXONOMY = [(1, "natural", "forest", "dry"), (2, "natural", "forest", "moist"), (3, "natural", "scrub", "dense"), (4, "human", "crop", "annual"), (5, "human", "crop", "tree"), (6, "bare", "desert", "sand"), (7, "water", "water", "lake")]
_TX = "tx AS (SELECT * FROM (VALUES " + ", ".join(map(str, TAXONOMY)) + ") t(class_id, n1, n2, n3))"


def taxonomy(s):
    return F.broadcast(s.createDataFrame(TAXONOMY, "class_id int, n1 string, n2 string, n3 string"))


def segments_px(s, d):
    return sq.segments(s, d)


def merged(s, d, how):
    nodes, edges = graph.region_graph(segments_px(s, d), "segment_id", ["b1", "b2"])
    return how(nodes.withColumnRenamed("segment_id", "region"), edges, ["b1", "b2"])


#: Regions and their roots turn by turn: every turn works out means and distances of what the turns before have merged.
_TURNS = f"""WITH RECURSIVE {sq._SEG}, base AS MATERIALIZED (SELECT segment_id AS region, n, b1 * n AS v1, b2 * n AS v2 FROM nd),
st(turn, region, root) AS (SELECT 0, region, region FROM base UNION ALL
  SELECT s.turn + 1, s.region, coalesce(m.target, s.root) FROM st s JOIN (SELECT count(*) AS moves FROM (MOVES)) ON moves > 0 LEFT JOIN (MOVES) m ON m.gone = s.root),
fin AS (SELECT region, root AS merged FROM st WHERE turn = (SELECT max(turn) FROM st))"""
_WEIGHTS = """SELECT DISTINCT p.root AS a, q.root AS b, p.n, sqrt((p.m1 - q.m1) * (p.m1 - q.m1) + (p.m2 - q.m2) * (p.m2 - q.m2)) AS w FROM (SELECT a, b FROM ed UNION ALL SELECT b, a FROM ed) e
  JOIN st x ON x.region = e.a JOIN st y ON y.region = e.b AND x.root <> y.root
  JOIN (SELECT root, sum(n) AS n, sum(v1) / sum(n) AS m1, sum(v2) / sum(n) AS m2 FROM st JOIN base USING (region) GROUP BY 1) p ON p.root = x.root
  JOIN (SELECT root, sum(v1) / sum(n) AS m1, sum(v2) / sum(n) AS m2 FROM st JOIN base USING (region) GROUP BY 1) q ON q.root = y.root"""
_IN_ORDER = _TURNS.replace("MOVES", f"SELECT b AS gone, a AS target FROM ({_WEIGHTS}) WHERE a < b AND w < 8.0 ORDER BY w, a, b LIMIT 1") + " SELECT region, merged FROM fin"
_BEST = f"SELECT a, b FROM ({_WEIGHTS}) WHERE w < 4.0 QUALIFY row_number() OVER (PARTITION BY a ORDER BY w, least(a, b), greatest(a, b)) = 1"
_MUTUAL = _TURNS.replace("MOVES", f"SELECT i.b AS gone, i.a AS target FROM ({_BEST}) i JOIN ({_BEST}) j ON i.a = j.b AND i.b = j.a AND i.a < i.b") + " SELECT region, merged FROM fin"
_ABSORBED = _TURNS.replace("MOVES", f"SELECT a AS gone, b AS target FROM ({_WEIGHTS}) WHERE n < 60 ORDER BY n, a, w, b LIMIT 1") + " SELECT region, merged, sum(n) OVER (PARTITION BY merged) >= 60 AS resolved FROM fin JOIN base USING (region)"

_PSL = aq._SEL


#: One point after the other in order, with a list of those taken.
_SPACED = f"""WITH RECURSIVE {_PT}, two AS (SELECT p.id AS a, q.id AS b, p.lon AS lon1, p.lat AS lat1, q.lon AS lon2, q.lat AS lat2 FROM pt p JOIN pt q ON p.id < q.id AND p.k = q.k AND abs(p.lat - q.lat) < 0.6 AND abs(p.lon - q.lon) < 1.2), {geodesic_sql('two')},
cf AS (SELECT id, list(other) AS others FROM (SELECT a AS id, b AS other FROM geo WHERE metres < 60000 UNION ALL SELECT b, a FROM geo WHERE metres < 60000) GROUP BY 1),
od AS (SELECT pt.id, pt.k AS stratum, coalesce(others, []) AS others, row_number() OVER (ORDER BY pt.k, (pt.id * 2654435761 + 3) % 4294967296, pt.id) AS k FROM pt LEFT JOIN cf ON cf.id = pt.id),
go(k, taken, last) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT UNION ALL SELECT od.k, CASE WHEN list_has_any(others, taken) THEN taken ELSE list_append(taken, id) END, CASE WHEN list_has_any(others, taken) THEN NULL ELSE id END FROM go JOIN od ON od.k = go.k + 1)
SELECT id, stratum AS k, place FROM (SELECT id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY k) AS place FROM od WHERE id IN (SELECT last FROM go)) WHERE place <= 3"""


def answers(s, d):
    """Two reviewers' answers, the second keyed by another column and named in its table, beside the reference."""
    docs = ad.table(s, d, "documents")
    ref = ad.table(s, d, "labels").select(F.col("doc_id").alias("review_id"), F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("segment_uid"), F.when(F.col("doc_id") % 11 > 0, (F.col("quality") * 2 + F.col("toxic")).cast("string")).otherwise("?").alias("supervisor_class"))
    one = docs.select(F.col("doc_id").alias("review_id"), F.when(F.col("doc_id") % 5 > 0, F.length("source") % 4).alias("reviewer_class"))
    two = docs.where("doc_id % 2 = 0").select(F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("segment_uid"), F.when(F.col("doc_id") % 3 > 0, F.length("lang").cast("string")).otherwise("x").alias("reviewer_class"), F.lit("r7").alias("reviewer_id"))
    return labels.answers_with_reference({"first": one, "second": two}, ref, "supervisor_class", "reviewer_class")


def scenes(s, d):
    """Orders as scenes of four kinds: two Landsat generations, and Sentinel-2 with its two ways to name the sun; the last without clouds."""
    o = ad.table(s, d, "orders").withColumn("kind", F.col("o_orderkey") % 4)
    day, cloud, azimuth, height = F.date_format("o_orderdate", "yyyy-MM-dd"), *((F.col("o_custkey") % n).cast("double") for n in (100, 360, 90))
    of = lambda kinds, value: F.when(F.col("kind").isin(*kinds), value)
    return o.select(
        "o_orderkey", of([0, 1], cloud).alias("CLOUD_COVER"), of([2], cloud).alias("CLOUDY_PIXEL_PERCENTAGE"), of([0, 1], day).alias("DATE_ACQUIRED"), of([2], day).alias("SENSING_TIME"), of([3], day).alias("GENERATION_TIME"),
        of([0], F.lit("LANDSAT_8")).alias("SPACECRAFT_ID"), of([1], F.lit("LANDSAT_5")).alias("SATELLITE"), F.when(F.col("kind") == 2, "Sentinel-2A").when(F.col("kind") == 3, "Sentinel-2B").alias("SPACECRAFT_NAME"),
        of([0, 1], azimuth).alias("SUN_AZIMUTH"), of([2], azimuth).alias("SOLAR_AZIMUTH_ANGLE"), of([3], azimuth).alias("MEAN_SOLAR_AZIMUTH_ANGLE"),
        of([0, 1], height).alias("SUN_ELEVATION"), of([2], height).alias("SOLAR_ZENITH_ANGLE"), of([3], height).alias("MEAN_SOLAR_ZENITH_ANGLE"),
    )


def report(s, d):
    """The long plan as it comes back from the run's CSV, with the run's number of rows and of its role from the summary."""
    path = shared_dir(s, "report")
    tb.write_report(rp.long_plan(aq.plan(s, d)), path, ["role"])
    _, rows, summary = tb.read_report(s, path)
    whole = summary.where("name = 'rows'").select(F.col("n").alias("n_rows"))
    return rows.join(summary.where("name = 'role'").select(F.col("value").alias("role"), F.col("n").alias("n_role")), "role").crossJoin(F.broadcast(whole))


def sweep_rows(s, d, year):
    o = ad.table(s, d, "orders").where(F.year("o_orderdate") == year)
    key = [(F.col("o_custkey") % 4).alias("scale"), (F.col("o_custkey") % 3).alias("sigma"), (F.col("o_orderkey") % 5).alias("percentile")]
    return o.groupBy(*key).agg(F.when(F.col("scale") != 3, F.min("o_totalprice")).cast("double").alias("threshold"), F.count("*").alias("n"))


def thresholds(s, d):
    """A sweep again for two percentiles: with the thresholds found before, its rows in place of the old ones."""
    old, key = sweep_rows(s, d, 1996), ["scale", "sigma", "percentile"]
    return rp.upsert(old, tb.reuse_thresholds(sweep_rows(s, d, 1997).where("percentile in (0, 1)"), old, key).select(*old.columns), key)


def files(s, d):
    """Boxes that a selection file has: one in ten, in six files."""
    names = ["seleccion_grilla_ssl4eo_a_UTM18_scale300", "seleccion_grilla_ssl4eo_muestras_UTM19_scale300", "seleccion_grilla_ssl4eo_b_UTM18_scale900", "reservas_UTM18_scale300", "seleccion_grilla_ssl4eo_a_UTM18_scale300_taxonomia", "seleccion_grilla_ssl4eo_c_UTM19_scale300"]
    return boxes(s, d).where("box_id % 60 < 6").withColumn("file", F.element_at(F.array(*map(F.lit, names)), (F.col("box_id") % 60 + 1).cast("int")))


QUERIES = {
    "a15_run_report": (report, f"{_PSL} SELECT *, count(*) OVER () AS n_rows, count(*) OVER (PARTITION BY role) AS n_role FROM lg"),
    "m4_threshold_reuse": (
        thresholds,
        """WITH r AS (SELECT y, scale, sigma, percentile, CASE WHEN scale <> 3 THEN CAST(min(o_totalprice) AS DOUBLE) END AS threshold, count(*) AS n FROM (SELECT year(o_orderdate) AS y, o_custkey % 4 AS scale, o_custkey % 3 AS sigma, o_orderkey % 5 AS percentile, o_totalprice FROM orders) WHERE y IN (1996, 1997) GROUP BY y, scale, sigma, percentile),
a AS (SELECT * FROM r WHERE y = 1996), b AS (SELECT scale, sigma, percentile, coalesce(a.threshold, r.threshold) AS threshold, r.n FROM r LEFT JOIN a USING (scale, sigma, percentile) WHERE r.y = 1997 AND percentile IN (0, 1))
SELECT * FROM b UNION ALL SELECT scale, sigma, percentile, threshold, n FROM a ANTI JOIN b USING (scale, sigma, percentile)""",
    ),
    "m14_arid_transition": (
        lambda s, d: selection.arid_transition(sq.metrics(s, d).select("grid_id", F.col("dominant_eco_id").alias("zone"), "transition_pct", F.col("dominant_class_id").alias("mode_id"), F.col("dominant_pct").alias("mode_pct"), (F.col("grid_id") % 5).alias("last_id"), F.lit(0.0).alias("last_pct")), 90.0, 30.0, (1, 2)).select("grid_id"),
        f"{sq._M} SELECT grid_id FROM mt WHERE (transition_pct >= 90 AND dominant_pct >= 30) OR (eco IN (1, 2) AND (transition_pct >= 88 OR (dominant_class_id <> grid_id % 5 AND dominant_class_id > 0 AND grid_id % 5 > 0 AND transition_pct >= 3)))",
    ),
    "m14_earlier_selections": (
        lambda s, d: lat.exclude_overlapping(boxes(s, d).where("box_id % 60 >= 6"), tb.earlier_selections(files(s, d), "a", "UTM18", "scale300").drop("file"), 4).select("box_id"),
        f"WITH {_BOX} SELECT box_id FROM box a WHERE box_id % 60 >= 6 AND NOT EXISTS (SELECT 1 FROM box b WHERE b.box_id % 60 IN (0, 1) AND least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0))",
    ),
    "d9_presence_outside_box": (lambda s, d: op.temporal_mode(ad.panel(s, d)).where("mode_id = 3 and not (px_row between 3 and 30 and px_col between 5 and 40)").select("px_row", "px_col"), f"{_W} SELECT px_row, px_col FROM pxmode WHERE mode_id = 3 AND NOT (px_row BETWEEN 3 AND 30 AND px_col BETWEEN 5 AND 40)"),
    "d10_calibration_candidates": (
        lambda s, d: lq.mj(s, d).where("purity >= 0.14").withColumn("p40", F.percentile("area_px", F.lit(0.4)).over(Window.partitionBy("mode_class"))).where("area_px >= p40").select("segment_id", "mode_class"),
        f"WITH {_SP}, {_MJ} SELECT segment_id, mode_class FROM (SELECT *, quantile_cont(area_px, 0.4) OVER (PARTITION BY mode_class) AS p40 FROM mj WHERE purity >= 0.14) WHERE area_px >= p40",
    ),
    "d11_distance_to_border": (
        lambda s, d: ad.panel(s, d).select("grid_id", "px_row", "px_col").distinct().withColumn("d", F.least(F.col("px_row") % 5, 4 - F.col("px_row") % 5, F.col("px_col") % 5, 4 - F.col("px_col") % 5)).groupBy("grid_id").agg(F.count(F.when(F.col("d") == 2, 1)).alias("n_core"), F.count(F.when(F.col("d") == 0, 1)).alias("n_border")),
        f"{_W}, q AS (SELECT DISTINCT grid_id, px_row, px_col FROM panel), r AS (SELECT grid_id, least(px_row % 5, 4 - px_row % 5, px_col % 5, 4 - px_col % 5) AS d FROM q) SELECT grid_id, count(*) FILTER (WHERE d = 2) AS n_core, count(*) FILTER (WHERE d = 0) AS n_border FROM r GROUP BY 1",
    ),
    "d12_valid_pixels": (lambda s, d: obs(s, d).groupBy("year").agg(F.round(F.avg((F.coalesce(*(F.lit(True),)) & (F.col("nir") > 0.05) & (F.col("red") > 0.06) & (F.col("qa") != 0)).cast("int")), 4).alias("valid")), f"WITH {OBS_SQL} SELECT year, round(avg(CASE WHEN nir > 0.05 AND red > 0.06 AND qa <> 0 THEN 1.0 ELSE 0.0 END), 4) AS valid FROM obs GROUP BY 1"),
    "d13_exclusion_mask": (
        lambda s, d: obs(s, d).join(ad.zone(s, d).where("eco_id in (0, 4)").select("px_row", "px_col", F.lit(1).alias("out")), ["px_row", "px_col"], "left").groupBy("year").agg(F.round(F.avg(F.col("out").isNotNull().cast("int")), 4).alias("masked"), F.round(F.avg(F.when(F.col("out").isNull(), F.col("nir"))), 4).alias("nir")),
        f"{_W}, {OBS_SQL} SELECT year, round(avg(CASE WHEN eco_id IN (0, 4) THEN 1.0 ELSE 0.0 END), 4) AS masked, round(avg(CASE WHEN eco_id IN (0, 4) THEN NULL ELSE CAST(nir AS DOUBLE) END), 4) AS nir FROM obs LEFT JOIN zone USING (px_row, px_col) GROUP BY 1",
    ),
    "e3_best_period": (
        lambda s, d: op.period_summary(ad.panel(s, d), ad.periods(s), pq._years(s, d)).groupBy("grid_id").agg(F.max(F.when(F.col("md_pct") >= 30, F.col("period"))).alias("latest"), F.max(F.when(F.col("md_pct") >= 30, F.col("md_pct"))).alias("best_pct")),
        f"{sq._PS_SQL} SELECT grid_id, max(period) FILTER (WHERE md_pct >= 30) AS latest, max(md_pct) FILTER (WHERE md_pct >= 30) AS best_pct FROM ps GROUP BY 1",
    ),
    "e13_harmonise_metadata": (
        lambda s, d: tb.harmonise_scenes(scenes(s, d), "o_orderkey"),
        """WITH o AS (SELECT *, o_orderkey % 4 AS kind, CAST(o_custkey % 100 AS DOUBLE) AS cloud, CAST(o_custkey % 360 AS DOUBLE) AS azimuth, CAST(o_custkey % 90 AS DOUBLE) AS height FROM orders)
SELECT o_orderkey, CASE WHEN kind < 3 THEN cloud END AS cloud_cover, CASE kind WHEN 0 THEN 'LANDSAT_8' WHEN 1 THEN 'LANDSAT_5' WHEN 2 THEN 'Sentinel-2A' ELSE 'Sentinel-2B' END AS satellite_name, azimuth AS sun_azimuth_angle,
  CASE WHEN kind < 2 THEN height ELSE 90 - height END AS sun_elevation_angle, strftime(o_orderdate, '%Y-%m-%d') AS date FROM o""",
    ),
    "e14_declared_types": (lambda s, d: obs(s, d).select(F.col("nir").cast("float"), F.col("qa").cast("smallint"), "year").groupBy("year").agg(F.count("nir").alias("n"), F.max("qa").alias("qa")), f"WITH {OBS_SQL} SELECT year, count(*) AS n, max(qa) AS qa FROM obs GROUP BY 1"),
    "e15_taxonomy": (
        lambda s, d: op.temporal_mode(ad.panel(s, d)).withColumnRenamed("mode_id", "class_id").join(taxonomy(s), "class_id", "left").groupBy(F.coalesce("n1", F.lit("unknown")).alias("n1"), F.coalesce("n2", F.lit("unknown")).alias("n2")).agg(F.count("*").alias("n")),
        f"{_W}, {_TX} SELECT coalesce(n1, 'unknown') AS n1, coalesce(n2, 'unknown') AS n2, count(*) AS n FROM pxmode LEFT JOIN tx ON class_id = mode_id GROUP BY 1, 2",
    ),
    "e16_critical_classes": (
        lambda s, d: op.area_by_class(op.temporal_mode(ad.panel(s, d))).where("ha > 0").groupBy("grid_id").agg(F.array_sort(F.collect_set("class_id")).alias("cs")).withColumn("hit", F.filter("cs", lambda x: x.isin(3, 7))).select("grid_id", F.array_join(F.transform("hit", lambda x: x.cast("string")), "; ").alias("names"), F.size("hit").alias("n"), (F.size("hit") > 0).alias("critical")),
        f"{_W} SELECT grid_id, coalesce(string_agg(CAST(class_id AS VARCHAR), '; ' ORDER BY class_id) FILTER (WHERE class_id IN (3, 7)), '') AS names, CAST(count(*) FILTER (WHERE class_id IN (3, 7)) AS INT) AS n, count(*) FILTER (WHERE class_id IN (3, 7)) > 0 AS critical FROM cell_class GROUP BY 1",
    ),
    "f1_metrics_with_bounds": (
        lambda s, d: sq.metrics(s, d).select("grid_id", "dominant_class_id").join(ad.panel(s, d).groupBy("grid_id").agg(F.min("px_row").alias("y0"), F.min("px_col").alias("x0"), (F.max("px_row") + 1).alias("y1"), (F.max("px_col") + 1).alias("x1")), "grid_id"),
        f"{_M} SELECT grid_id, dominant_class_id, min(px_row) AS y0, min(px_col) AS x0, max(px_row) + 1 AS y1, max(px_col) + 1 AS x1 FROM mt JOIN panel USING (grid_id) GROUP BY 1, 2",
    ),
    "f3_plan_with_zone": (
        lambda s, d: rp.long_plan(aq.plan(s, d)).join(sq.metrics(s, d).select("grid_id", "dominant_eco_id"), "grid_id").groupBy("dominant_eco_id", "role").agg(F.count("*").alias("n")),
        f"{_PSL}, {pq._ZONE} SELECT coalesce(zn.eco_id, 0) AS dominant_eco_id, role, count(*) AS n FROM lg LEFT JOIN zn USING (grid_id) GROUP BY 1, 2",
    ),
    "f12_near_points": (lambda s, d: merging.near_pairs(points(s, d), 30000.0).select("a", "b", F.round("metres", 1).alias("metres")), f"WITH {_PT}, two AS (SELECT p.id AS a, q.id AS b, p.lon AS lon1, p.lat AS lat1, q.lon AS lon2, q.lat AS lat2 FROM pt p JOIN pt q ON p.id < q.id AND abs(p.lat - q.lat) < 0.3 AND abs(p.lon - q.lon) < 0.6), {geodesic_sql('two')} SELECT a, b, round(metres, 1) AS metres FROM geo WHERE metres < 30000"),
    "f13_labels_on_segments": (
        lambda s, d: lq.mj(s, d).where("purity >= 0.16").select("segment_id", "mode_class").join(ad.table(s, d, "supplier").select(F.col("s_suppkey").alias("segment_id"), "s_nationkey"), "segment_id", "right"),
        f"WITH {_SP}, {_MJ} SELECT s_suppkey AS segment_id, mode_class, s_nationkey FROM (SELECT * FROM mj WHERE purity >= 0.16) m RIGHT JOIN supplier ON segment_id = s_suppkey",
    ),
    "f14_answers_with_reference": (
        lambda s, d: answers(s, d).groupBy("reviewer", "truth", "given").agg(F.count("*").alias("n")),
        """WITH ref AS (SELECT doc_id AS review_id, 'u' || doc_id AS segment_uid, CASE WHEN doc_id % 11 > 0 THEN quality * 2 + toxic END AS truth FROM labels), a AS (SELECT 'first' AS reviewer, truth, CASE WHEN doc_id % 5 > 0 THEN length(source) % 4 END AS given FROM ref LEFT JOIN documents ON doc_id = review_id WHERE truth IS NOT NULL
UNION ALL SELECT 'r7', truth, CASE WHEN doc_id % 3 > 0 THEN length(lang) END FROM ref LEFT JOIN (SELECT * FROM documents WHERE doc_id % 2 = 0) ON 'u' || doc_id = segment_uid WHERE truth IS NOT NULL) SELECT reviewer, CAST(truth AS INT) AS truth, CAST(given AS INT) AS given, count(*) AS n FROM a GROUP BY ALL""",
    ),
    "f16_plan_status": (
        lambda s, d: ad.table(s, d, "customer").select(F.col("c_custkey").alias("unit")).join(aq.rp.latest(aq.audits(s, d), ["unit"], "seq"), "unit", "left").withColumn("plan", F.when(F.col("status") == "complete", "done").when(F.col("status") == "failed", "ready").when(F.col("status") == "empty", "omitted").otherwise("missing")).groupBy("plan").agg(F.count("*").alias("n")),
        f"WITH {aq._AU} SELECT CASE status WHEN 'complete' THEN 'done' WHEN 'failed' THEN 'ready' WHEN 'empty' THEN 'omitted' ELSE 'missing' END AS plan, count(*) AS n FROM customer LEFT JOIN la ON unit = c_custkey GROUP BY 1",
    ),
    "g9_presence_order": (
        lambda s, d: selection.top_per_group(op.area_by_class(op.temporal_mode(ad.panel(s, d))).where("class_id in (3, 7)").withColumn("side", 2 + F.col("grid_id") % 2), ["class_id"], [F.col("side"), F.desc("ha"), F.col("grid_id")], 4).select("class_id", "grid_id", "rank"),
        f"{_W} SELECT * FROM (SELECT class_id, grid_id, CAST(row_number() OVER (PARTITION BY class_id ORDER BY 2 + grid_id % 2, ha DESC, grid_id) AS INT) AS rank FROM cell_class WHERE class_id IN (3, 7)) WHERE rank <= 4",
    ),
    "g19_spaced_pick": (lambda s, d: merging.spaced_pick(points(s, d), "k", [F.expr("(id * 2654435761 + 3) % 4294967296"), F.col("id")], 3, 60000.0).select("id", "k", "place"), _SPACED),
    "g20_pilot_per_zone": (
        lambda s, d: (lambda m, forced: forced.unionByName(selection.top_per_group(m.join(forced.select("dominant_eco_id").distinct(), "dominant_eco_id", "left_anti"), ["dominant_eco_id"], [F.desc("shannon"), F.col("grid_id")], 1).select("grid_id", "dominant_eco_id")))(sq.metrics(s, d), sq.metrics(s, d).where("grid_id in (1, 2)").select("grid_id", "dominant_eco_id")),
        f"{_M}, fo AS (SELECT grid_id, eco FROM mt WHERE grid_id IN (1, 2)) SELECT grid_id, eco AS dominant_eco_id FROM fo UNION ALL SELECT grid_id, eco FROM (SELECT *, row_number() OVER (PARTITION BY eco ORDER BY shannon DESC, grid_id) AS rk FROM mt WHERE eco NOT IN (SELECT eco FROM fo)) WHERE rk = 1",
    ),
    "h15_mutual_nearest_merge": (lambda s, d: merged(s, d, lambda n, e, b: merging.merge_mutual_nearest(n, e, b, 4.0)), _MUTUAL),
    "h15_merge_in_order": (lambda s, d: merged(s, d, lambda n, e, b: merging.merge_in_order(n, e, b, 8.0)), _IN_ORDER),
    "h16_absorb_small": (lambda s, d: merged(s, d, lambda n, e, b: merging.absorb_in_order(n, e, b, 60)), _ABSORBED),
    "i3_signature_table": (
        lambda s, d: labels.zonal_stats(lq.seg(s, d), "segment_id", ["b1", "b2"]).select(F.format_string("seg_%04d", F.col("segment_id")).alias("segment_uid"), "b1_mean", "b2_mean", (F.round(F.col("b1_std") + F.col("b2_std"), 4) / 2).alias("variation")),
        f"WITH {_SP} SELECT printf('seg_%04d', segment_id) AS segment_uid, round(avg(b1) FILTER (WHERE valid), 4) AS b1_mean, round(avg(b2) FILTER (WHERE valid), 4) AS b2_mean, round(round(stddev_pop(b1) FILTER (WHERE valid), 4) + round(stddev_pop(b2) FILTER (WHERE valid), 4), 4) / 2 AS variation FROM sp GROUP BY segment_id",
    ),
    "i17_sweep_against_base": (
        lambda s, d: (lambda t: t.where("tau <> 0.15").join(t.where("tau = 0.15").select("status", F.col("n").alias("base")), "status", "left").select("tau", "status", "n", F.col("n") - F.coalesce("base", F.lit(0)), F.round(F.try_divide("n", "base"), 4).alias("ratio")).toDF("tau", "status", "n", "delta", "ratio"))(labels.threshold_sweep(lq.mj(s, d), (0.15, 0.16, 0.18), 0.88, 5)),
        f"WITH {_SP}, {_MJ}, t AS (SELECT tau, CASE WHEN n_valid < 5 OR coverage < 0.88 OR mode_class IS NULL THEN 'no_data' WHEN purity < tau THEN 'mixed' ELSE 'ok' END AS status, count(*) AS n FROM mj, (VALUES (0.15::DOUBLE), (0.16), (0.18)) t(tau) GROUP BY 1, 2) SELECT a.tau, a.status, a.n, a.n - coalesce(b.n, 0) AS delta, round(a.n / b.n, 4) AS ratio FROM t a LEFT JOIN t b ON b.tau = 0.15 AND b.status = a.status WHERE a.tau <> 0.15",
    ),
    "j7_promote_median": (
        lambda s, d: (lambda c: c.select("px_row", *(F.col(x).alias(x.removesuffix("_median")) for x in c.columns if x.endswith("_median"))))(lq.cp.seasonal(lq.zobs(s, d), ["px_row"], "ndvi", ["nir", "red"])),
        f"WITH {lq._ZO} SELECT px_row, round(median(nir), 4) AS nir, round(median(red), 4) AS red FROM zo GROUP BY 1",
    ),
    "j9_yearly_mosaic": (
        lambda s, d: obs(s, d).where("(qa & 24) = 0").groupBy(F.expr("px_row DIV 10").alias("tile"), "year").agg(*(F.round(F.median(b), 4).alias(b) for b in _BANDS)),
        f"WITH {OBS_SQL} SELECT px_row // 10 AS tile, year, " + ", ".join(f"round(median(CAST({b} AS DOUBLE)), 4) AS {b}" for b in _BANDS) + " FROM obs WHERE qa & 24 = 0 GROUP BY 1, 2",
    ),
    "m2_band_profile": (
        lambda s, d: obs(s, d).select("qa", *_BANDS).unpivot(["qa"], list(_BANDS), "band", "value").groupBy("band").agg(F.min("value").alias("least"), F.max("value").alias("most"), F.round(F.avg("value"), 4).alias("mean"), F.round(F.avg((F.col("qa") % 8 == 0).cast("int")), 4).alias("nodata")),
        f"WITH {OBS_SQL} " + " UNION ALL ".join(f"SELECT '{b}' AS band, CAST(min({b}) AS DOUBLE) AS least, CAST(max({b}) AS DOUBLE) AS most, round(avg(CAST({b} AS DOUBLE)), 4) AS mean, round(avg(CASE WHEN qa % 8 = 0 THEN 1.0 ELSE 0.0 END), 4) AS nodata FROM obs" for b in _BANDS),
    ),
    "m7_first_value_wins": (
        lambda s, d: obs(s, d).groupBy("px_row", "px_col").agg(F.min_by("qa", F.struct("scene_id", "line", "qa")).alias("qa")),
        f"WITH {OBS_SQL} SELECT px_row, px_col, qa FROM (SELECT *, row_number() OVER (PARTITION BY px_row, px_col ORDER BY scene_id, line, qa) AS rk FROM obs) WHERE rk = 1",
    ),
    "m8_source_kind": (lambda s, d: ad.panel(s, d).groupBy("year").agg(F.count_distinct("class_id").alias("n")).withColumn("kind", F.when(F.col("n") <= 2, "binary").otherwise("multi")), f"{_W} SELECT year, count(DISTINCT class_id) AS n, CASE WHEN count(DISTINCT class_id) <= 2 THEN 'binary' ELSE 'multi' END AS kind FROM panel GROUP BY 1"),
    "m9_zone_lookup": (lambda s, d: ad.table(s, d, "lineitem").join(ad.table(s, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("l_partkey").alias("cell")).agg(F.min_by("s_nationkey", F.struct("l_orderkey", "l_linenumber", "l_suppkey")).alias("zone")), "SELECT cell, zone FROM (SELECT l_partkey AS cell, s_nationkey AS zone, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) AS rk FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) WHERE rk = 1"),
    "m12_same_lattice": (
        lambda s, d: ad.panel(s, d).where("year = 1996").select("px_row", "px_col", F.lit(1).alias("a")).join(ad.panel(s, d).where("year = 1997").select("px_row", "px_col", F.lit(1).alias("b")), ["px_row", "px_col"], "full_outer").agg(F.count(F.when(F.col("a").isNull(), 1)).alias("only_second"), F.count(F.when(F.col("b").isNull(), 1)).alias("only_first"), F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("both")),
        f"{_W} SELECT count(*) FILTER (WHERE a.px_row IS NULL) AS only_second, count(*) FILTER (WHERE b.px_row IS NULL) AS only_first, count(*) FILTER (WHERE a.px_row IS NOT NULL AND b.px_row IS NOT NULL) AS both FROM (SELECT * FROM panel WHERE year = 1996) a FULL JOIN (SELECT * FROM panel WHERE year = 1997) b ON a.px_row = b.px_row AND a.px_col = b.px_col",
    ),
    "m15_taxonomy_counts": (
        lambda s, d: sq.metrics(s, d).select(F.col("dominant_class_id").alias("class_id")).join(taxonomy(s), "class_id", "left").groupBy(F.coalesce("n3", F.lit("unknown")).alias("n3")).agg(F.count("*").alias("n")),
        f"{_M}, {_TX} SELECT coalesce(n3, 'unknown') AS n3, count(*) AS n FROM mt LEFT JOIN tx ON class_id = dominant_class_id GROUP BY 1",
    ),
    "m16_clean_labels": (lambda s, d: patches(s, d).select(F.coalesce(F.nullif(F.trim("poly_qa"), F.lit("")), F.lit("none")).alias("label")).groupBy("label").agg(F.count("*").alias("n")), f"WITH {_PQ} SELECT coalesce(nullif(trim(poly_qa), ''), 'none') AS label, count(*) AS n FROM pq GROUP BY 1"),
    "m16_review_columns": (
        lambda s, d: labels.prepare_columns(ad.table(s, d, "orders").select(F.col("o_orderkey").alias("grid_id"), F.concat(F.lit("  "), F.regexp_replace("o_orderpriority", "-", "  "), F.lit("\t")).alias("review_label"), F.when(F.col("o_orderkey") % 3 == 0, " NaN ").when(F.col("o_orderkey") % 3 == 1, F.col("o_orderstatus")).alias("lulc_mode_name")), ["review_label", "lulc_mode_name"]),
        "SELECT CAST(o_orderkey AS VARCHAR) AS grid_id, '' AS sample_type, '' AS review_years, CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus ELSE 'none' END AS lulc_mode_name, '' AS eco_dom_name, '' AS target_rare_class, trim(regexp_replace(replace(o_orderpriority, '-', '  '), '\\s+', ' ', 'g')) AS review_label, '' AS review_notes FROM orders",
    ),
    "m17_plan_sanity": (
        lambda s, d: aq.plan(s, d).agg(F.count("*").alias("n"), (F.count("*") - F.count_distinct("grid_id")).alias("n_duplicates"), F.count(F.when(F.col("rev_year1") == rp.NONE, 1)).alias("n_without_year")),
        f"{_PSL} SELECT count(*) AS n, count(*) - count(DISTINCT grid_id) AS n_duplicates, count(*) FILTER (WHERE rev_year1 = -9999) AS n_without_year FROM pl",
    ),
    "m18_composite_of_labelled": (
        lambda s, d: ix.stretch(obs(s, d).join(op.temporal_mode(ad.panel(s, d)).where("mode_id in (1, 2, 3)").select("px_row", "px_col"), ["px_row", "px_col"]).select("px_row", "scene_id", "red", "nir"), ["px_row"], ["red", "nir"]).groupBy("px_row").agg(F.sum("red").alias("red"), F.count("*").alias("n")),
        f"{_W}, {OBS_SQL}, o AS (SELECT px_row, CAST(red AS DOUBLE) AS red FROM obs JOIN (SELECT px_row, px_col FROM pxmode WHERE mode_id IN (1, 2, 3)) USING (px_row, px_col)), p AS (SELECT px_row, quantile_cont(red, 0.02) AS a, quantile_cont(red, 0.98) AS b FROM o GROUP BY 1) SELECT px_row, CAST(sum(floor(least(greatest(coalesce((red - a) / nullif(b - a, 0), 0.0), 0.0), 1.0) * 255)) AS BIGINT) AS red, count(*) AS n FROM o JOIN p USING (px_row) GROUP BY 1",
    ),
}
