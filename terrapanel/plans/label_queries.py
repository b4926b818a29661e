"""Label, review and composite queries over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapanel.operators import composite as cp
from terrapanel.operators import labels as lb
from terrapanel.operators import masks as mk
from terrapanel.operators import panel as op
from terrapanel.operators.percentiles import exact_percentiles, weighted_percentiles
from terrapanel.plans.grid_queries import OBS_SQL, obs
from terrapanel.sources import adapters as ad

_W = "WITH " + ad.SQL
_SP = "sp AS (SELECT l_suppkey AS segment_id, l_partkey % 9 AS class_id, CAST(l_quantity AS INT) AS b1, CAST(l_linenumber AS INT) AS b2, l_tax < 0.07 AS valid FROM lineitem)"
_SX = "sx AS (SELECT px_row, px_col, min(s) AS segment_id FROM (SELECT CAST(l_partkey // 50 AS INT) AS px_row, CAST(l_partkey % 50 AS INT) AS px_col, l_suppkey % 40 AS s FROM lineitem) GROUP BY 1, 2)"
_MJ = "ct AS (SELECT segment_id, class_id, count(*) AS n FROM sp WHERE class_id <> 0 GROUP BY 1, 2), rk AS (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY n DESC, class_id) AS rk, sum(n) OVER (PARTITION BY segment_id) AS nv, count(*) OVER (PARTITION BY segment_id) AS nc FROM ct), mj AS (SELECT a.segment_id, area_px, CAST(coalesce(nv, 0) AS BIGINT) AS n_valid, class_id AS mode_class, round(coalesce(n / nv, 0), 4) AS purity, round(coalesce(nv, 0) / area_px, 4) AS coverage FROM (SELECT segment_id, count(*) AS area_px FROM sp GROUP BY 1) a LEFT JOIN (SELECT * FROM rk WHERE rk = 1) r ON r.segment_id = a.segment_id)"


def seg(s, d):
    return ad.table(s, d, "lineitem").select(F.col("l_suppkey").alias("segment_id"), (F.col("l_partkey") % 9).alias("class_id"), F.col("l_quantity").cast("int").alias("b1"), F.col("l_linenumber").alias("b2"), (F.col("l_tax") < 0.07).alias("valid"))


def seg_px(s, d):
    return ad.table(s, d, "lineitem").groupBy(*ad.pixel("l_partkey")).agg(F.min(F.col("l_suppkey") % 40).alias("segment_id"))


def mj(s, d):
    return lb.majority(seg(s, d), "segment_id", "class_id")


def patches(s, d):
    """Review patches from orders: status, class, correction and area."""
    t = ad.table(s, d, "orders")
    return t.select(F.col("o_orderkey").alias("poly_uid"), (F.col("o_custkey") % 30).alias("grid_id"), F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "P", "rejected").alias("poly_qa"), (F.col("o_orderkey") % 7 + 1).cast("int").alias("class_id"), F.when(F.col("o_orderkey") % 5 == 0, (F.col("o_orderkey") % 9).cast("int")).alias("corr_id"), F.floor("o_totalprice").cast("long").alias("area_ha"))


_PQ = "pq AS (SELECT o_orderkey AS poly_uid, o_custkey % 30 AS grid_id, CASE WHEN o_orderstatus = 'F' THEN 'approved' WHEN o_orderstatus = 'P' THEN 'rejected' END AS poly_qa, CAST(o_orderkey % 7 + 1 AS INT) AS class_id, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 9 AS INT) END AS corr_id, CAST(floor(o_totalprice) AS BIGINT) AS area_ha FROM orders)"


def edits(s, d):
    """Review edits from the events' JSON: which patch, which status."""
    e = ad.table(s, d, "events").withColumn("p", F.from_json("props", "k int"))
    return e.select(F.col("p.k").cast("long").alias("poly_uid"), F.col("event_type").alias("poly_qa"), F.when(F.col("value") > 50, 9).alias("corr_id"), F.col("event_id").alias("seq"))


_ED = "ed AS (SELECT * FROM (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS poly_uid, event_type AS e_qa, CASE WHEN value > 50 THEN 9 END AS e_corr, row_number() OVER (PARTITION BY CAST(json_extract(props, '$.k') AS BIGINT) ORDER BY event_id DESC) AS rk FROM events) WHERE rk = 1)"


def reviews(s, d):
    docs = ad.table(s, d, "documents").select("doc_id", "source", "lang")
    return ad.table(s, d, "labels").join(docs, "doc_id")


def zobs(s, d):
    return obs(s, d).withColumn("ndvi", (F.col("nir") - F.col("red")) / (F.col("nir") + F.col("red")))


_ZO = f"{OBS_SQL}, zo AS (SELECT * REPLACE (CAST(nir AS DOUBLE) AS nir, CAST(red AS DOUBLE) AS red, CAST(swir1 AS DOUBLE) AS swir1), (CAST(nir AS DOUBLE) - red) / (CAST(nir AS DOUBLE) + red) AS ndvi FROM obs)"


_BANDS6 = ("blue", "green", "red", "nir", "swir1", "swir2")
HEIGHTS = (60, 150, 300)


def images(s, d):
    """An image a year: of each pixel the least of every band and of the quality word."""
    return obs(s, d).groupBy("px_row", "px_col", "year").agg(*(F.min(b).cast("double").alias(b) for b in _BANDS6), F.min("qa").alias("qa"))


def all_masks(s, d, **flags):
    suns = images(s, d).select("year").distinct().select("year", (F.col("year") * 37 % 360).cast("double").alias("sun_azimuth_angle"), (F.lit(20.0) + F.col("year") % 50).alias("sun_elevation_angle"))
    return mk.all_masks(images(s, d), ["year"], suns, HEIGHTS, 30.0, score_over=0.6, z=0.5, most=1.5, reach=1, **flags)


#: Every neighbourhood as a list of offsets, every mask as a join.
_IMAGES = f"""WITH {OBS_SQL}, im AS MATERIALIZED (SELECT px_row, px_col, year, {", ".join(f"CAST(min({b}) AS DOUBLE) AS {b}" for b in _BANDS6)}, min(qa) AS qa, min(qa) & 8 <> 0 AS cloud FROM obs GROUP BY 1, 2, 3),
zs AS (SELECT *, coalesce((nir - avg(nir) OVER w) / nullif(stddev_pop(nir) OVER w, 0) < 0.5 AND (swir1 - avg(swir1) OVER w) / nullif(stddev_pop(swir1) OVER w, 0) < 0.5 AND nir + swir1 < 1.5, FALSE) AS dark FROM im WINDOW w AS (PARTITION BY px_row, px_col)),
disc AS (SELECT r, c FROM (SELECT unnest(range(-1, 2)) AS r), (SELECT unnest(range(-1, 2)) AS c) WHERE r * r + c * c <= 1),
td AS MATERIALIZED (SELECT im.*, t.tdom FROM im JOIN (SELECT a.px_row, a.px_col, a.year, bool_and(b.dark) AS tdom FROM zs a, disc JOIN zs b ON b.px_row = a.px_row + r AND b.px_col = a.px_col + c AND b.year = a.year GROUP BY 1, 2, 3) t USING (px_row, px_col, year)),
way AS (SELECT year, CAST(round(sin(az) * far) AS INT) AS dr, CAST(round(cos(az) * far) AS INT) AS dc FROM (SELECT year, (year * 37 % 360) * pi() / 180.0 + 0.5 * pi() AS az, tan(0.5 * pi() - (20.0 + year % 50) * pi() / 180.0) * h / 30.0 AS far FROM (SELECT DISTINCT year FROM im), (SELECT unnest([60.0::DOUBLE, 150.0, 300.0]) AS h))),
cast_ AS (SELECT DISTINCT px_row + dr + r AS px_row, px_col + dc + c AS px_col, year FROM im JOIN way USING (year), disc WHERE cloud),
sh AS MATERIALIZED (SELECT td.*, s.year IS NOT NULL AND nir + swir1 + swir2 < 1.5 AND NOT tdom AND NOT cloud AS shadow FROM td LEFT JOIN cast_ s USING (px_row, px_col, year))"""
_SCORE = "least(1.0, greatest((blue - 0.1) / 0.2, 0.0), greatest((blue + green + red - 0.2) / 0.6, 0.0), greatest((nir + swir1 + swir2 - 0.3) / 0.5, 0.0), greatest((CASE WHEN green + swir1 <> 0 THEN (green - swir1) / (green + swir1) END - 0.8) / -0.2, 0.0))"


def modes(s, d):
    return op.temporal_mode(ad.panel(s, d))


RULES = {"no_status": ("error", "poly_qa is null"), "bad_correction": ("error", "corr_id > 7"), "tiny": ("warning", "area_ha < 20000")}

QUERIES = {
    "i1_zonal_stats": (
        lambda s, d: lb.zonal_stats(seg(s, d), "segment_id", ["b1", "b2"]),
        f"WITH {_SP} SELECT segment_id, count(*) AS n_px, count(*) FILTER (WHERE valid) AS n_valid, round(1 - count(*) FILTER (WHERE valid) / count(*), 4) AS nodata_share, round(avg(b1) FILTER (WHERE valid), 4) AS b1_mean, round(median(b1) FILTER (WHERE valid), 4) AS b1_median, round(stddev_pop(b1) FILTER (WHERE valid), 4) AS b1_std, round(avg(b2) FILTER (WHERE valid), 4) AS b2_mean, round(median(b2) FILTER (WHERE valid), 4) AS b2_median, round(stddev_pop(b2) FILTER (WHERE valid), 4) AS b2_std FROM sp GROUP BY 1",
    ),
    "i2_shapes": (
        lambda s, d: lb.shapes(seg_px(s, d), "segment_id"),
        f"WITH {_SX}, i AS (SELECT a.segment_id AS s, count(*) AS inn FROM sx a JOIN sx b ON a.segment_id = b.segment_id AND abs(a.px_row - b.px_row) + abs(a.px_col - b.px_col) = 1 GROUP BY 1), m AS (SELECT segment_id AS s, count(*) AS area, var_pop(px_row) AS vr, var_pop(px_col) AS vc, covar_pop(px_row, px_col) AS cv FROM sx GROUP BY 1), p AS (SELECT m.*, 4 * area - coalesce(inn, 0) AS perimeter, (vr + vc) / 2 + 1 / 12 AS hf, sqrt(pow((vr - vc) / 2, 2) + pow(cv, 2)) AS rt FROM m LEFT JOIN i USING (s)) SELECT s AS segment_id, area, perimeter, round(4 * 3.141592653589793 * area / pow(perimeter, 2), 4) AS compactness, round(sqrt((hf + rt) / greatest(hf - rt, 1 / 12)), 4) AS elongation FROM p",
    ),
    "i4_majority_label": (mj, f"WITH {_SP}, {_MJ} SELECT * FROM mj"),
    "i5_top_classes": (
        lambda s, d: lb.top_classes(seg(s, d), "segment_id", "class_id", (3, 7)),
        f"WITH {_SP}, {_MJ} SELECT segment_id, max(nc) AS n_classes, " + ", ".join(f"coalesce(max(CASE WHEN rk = {k} THEN class_id END), 0) AS class_{k}, round(coalesce(max(CASE WHEN rk = {k} THEN 100.0 * n / nv END), 0), 2) AS share_{k}" for k in (1, 2, 3)) + ", bool_or(class_id IN (3, 7)) AS has_protected FROM rk GROUP BY segment_id",
    ),
    "i6_labelling_summary": (
        lambda s, d: mj(s, d).agg(F.count("*").alias("n"), F.count(F.when(F.col("purity") >= 0.2, 1)).alias("clean"), F.count(F.when(F.col("purity").between(0.15, 0.19), 1)).alias("boundary"), F.count(F.when(F.col("mode_class").isin(3, 7), 1)).alias("protected")),
        f"WITH {_SP}, {_MJ} SELECT count(*) AS n, count(*) FILTER (WHERE purity >= 0.2) AS clean, count(*) FILTER (WHERE purity BETWEEN 0.15 AND 0.19) AS boundary, count(*) FILTER (WHERE mode_class IN (3, 7)) AS protected FROM mj",
    ),
    "i7_assign": (
        lambda s, d: lb.assign(mj(s, d), 0.16, 0.88, 5).select("segment_id", "status", "label"),
        f"WITH {_SP}, {_MJ}, a AS (SELECT *, CASE WHEN n_valid < 5 OR coverage < 0.88 OR mode_class IS NULL THEN 'no_data' WHEN purity < 0.16 THEN 'mixed' ELSE 'ok' END AS status FROM mj) SELECT segment_id, status, CASE status WHEN 'ok' THEN mode_class WHEN 'mixed' THEN 255 ELSE 254 END AS label FROM a",
    ),
    "i8_threshold_sweep": (
        lambda s, d: lb.threshold_sweep(mj(s, d), (0.15, 0.16, 0.18), 0.88, 5),
        f"WITH {_SP}, {_MJ} SELECT tau, CASE WHEN n_valid < 5 OR coverage < 0.88 OR mode_class IS NULL THEN 'no_data' WHEN purity < tau THEN 'mixed' ELSE 'ok' END AS status, count(*) AS n, CAST(sum(area_px) AS BIGINT) AS px FROM mj, (VALUES (0.15::DOUBLE), (0.16), (0.18)) t(tau) GROUP BY 1, 2",
    ),
    "i9_purity_percentiles": (
        lambda s, d: exact_percentiles(mj(s, d), "purity", (0.1, 0.25, 0.5, 0.75, 0.9)).agg(*(F.round(F.max(F.when(F.col("share") == q, F.col("value"))), 4).alias(n) for q, n in ((0.1, "p10"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.9, "p90")))),
        f"WITH {_SP}, {_MJ} SELECT " + ", ".join(f"round(quantile_cont(purity, {q}), 4) AS {n}" for q, n in ((0.1, "p10"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.9, "p90"))) + " FROM mj",
    ),
    "i9_weighted_percentiles": (
        lambda s, d: weighted_percentiles(mj(s, d).withColumn("half", F.col("segment_id") % 2), "purity", "area_px", (0.1, 0.25, 0.5, 0.75, 0.9), ["half"]).withColumn("value", F.round("value", 4)),
        f"WITH {_SP}, {_MJ}, q AS (SELECT segment_id % 2 AS half, purity, sum(area_px) AS w FROM mj WHERE purity IS NOT NULL GROUP BY 1, 2), c AS (SELECT *, sum(w) OVER (PARTITION BY half ORDER BY purity) AS upto, sum(w) OVER (PARTITION BY half) AS whole FROM q) SELECT half, share, round(min(purity), 4) AS value FROM c, (SELECT unnest([0.1::DOUBLE, 0.25, 0.5, 0.75, 0.9]) AS share) WHERE upto >= share * whole GROUP BY 1, 2",
    ),
    "i9_purity_histogram": (lambda s, d: lb.histogram(mj(s, d), "purity", 0.0, 1.0, 64, "area_px"), f"WITH {_SP}, {_MJ} SELECT CAST(least(floor(purity / (1.0::DOUBLE / 64)), 63) AS INT) AS bin, count(*) AS n, CAST(sum(area_px) AS BIGINT) AS weight FROM mj GROUP BY 1"),
    "i10_purity_layer": (lambda s, d: seg_px(s, d).join(mj(s, d).select("segment_id", "purity"), "segment_id", "left").select("px_row", "px_col", "purity"), f"WITH {_SP}, {_MJ}, {_SX} SELECT px_row, px_col, purity FROM sx LEFT JOIN mj USING (segment_id)"),
    "i11_effective_label": (lambda s, d: lb.effective_label(patches(s, d)).select("poly_uid", "poly_qa", "lbl_id"), f"WITH {_PQ} SELECT poly_uid, coalesce(poly_qa, 'pending') AS poly_qa, CASE WHEN corr_id > 0 THEN corr_id ELSE class_id END AS lbl_id FROM pq"),
    "i12_approved_share": (lambda s, d: lb.approved_share(patches(s, d), ["grid_id"]).select("poly_uid", "cov_rect"), f"WITH {_PQ} SELECT poly_uid, round(sum(CASE WHEN poly_qa = 'approved' THEN area_ha ELSE 0 END) OVER (PARTITION BY grid_id) / sum(area_ha) OVER (PARTITION BY grid_id), 4) AS cov_rect FROM pq"),
    "i13_constraint_report": (
        lambda s, d: lb.constraint_report(patches(s, d), "poly_uid", {k: (sev, F.expr(c)) for k, (sev, c) in RULES.items()}),
        f"WITH {_PQ} SELECT 'no_status' AS rule, 'error' AS severity, CAST(poly_uid AS VARCHAR) AS key FROM pq WHERE poly_qa IS NULL UNION ALL SELECT 'bad_correction', 'error', CAST(poly_uid AS VARCHAR) FROM pq WHERE corr_id > 7 UNION ALL SELECT 'tiny', 'warning', CAST(poly_uid AS VARCHAR) FROM pq WHERE area_ha < 20000",
    ),
    "i14_apply_edits": (lambda s, d: lb.apply_edits(patches(s, d), edits(s, d), "poly_uid", ["poly_qa", "corr_id"]), f"WITH {_PQ}, {_ED} SELECT pq.poly_uid, grid_id, coalesce(e_qa, poly_qa) AS poly_qa, class_id, coalesce(e_corr, corr_id) AS corr_id, area_ha FROM pq LEFT JOIN ed ON ed.poly_uid = pq.poly_uid"),
    "i15_bulk_decisions": (
        lambda s, d: patches(s, d).withColumn("share", F.col("area_ha") / F.sum("area_ha").over(lb.Window.partitionBy("grid_id"))).where("poly_qa is null").select("poly_uid", F.when(F.col("share") >= 0.05, "approved").when(F.col("share") < 0.01, "rejected").otherwise("pending").alias("decision")),
        f"WITH {_PQ} SELECT poly_uid, CASE WHEN share >= 0.05 THEN 'approved' WHEN share < 0.01 THEN 'rejected' ELSE 'pending' END AS decision FROM (SELECT *, area_ha / sum(area_ha) OVER (PARTITION BY grid_id) AS share FROM pq) WHERE poly_qa IS NULL",
    ),
    "i16_agreement": (
        lambda s, d: lb.agreement(reviews(s, d), "quality", "toxic"),
        "WITH c AS (SELECT quality AS t, toxic AS g, count(*) AS n FROM labels GROUP BY 1, 2), s AS (SELECT sum(n) AS n, sum(CASE WHEN t = g THEN n ELSE 0 END) AS same FROM c), e AS (SELECT sum(r * k) AS ch FROM (SELECT t AS c, sum(n) AS r FROM c GROUP BY 1) JOIN (SELECT g AS c, sum(n) AS k FROM c GROUP BY 1) USING (c)) SELECT CAST(n AS BIGINT) AS n, round(same / n, 4) AS accuracy, round((same / n - ch / pow(n, 2)) / (1 - ch / pow(n, 2)), 4) AS kappa FROM s, e",
    ),
    "i16_confusion": (lambda s, d: lb.confusion(reviews(s, d), "quality", "toxic"), "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2"),
    "i16_accuracy_per_class": (lambda s, d: reviews(s, d).groupBy("quality").agg(F.count("*").alias("n"), F.round(F.avg((F.col("quality") == F.col("toxic")).cast("int")), 4).alias("accuracy")), "SELECT quality, count(*) AS n, round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 4) AS accuracy FROM labels GROUP BY 1"),
    "j1_seasonal": (
        lambda s, d: cp.seasonal(zobs(s, d), ["px_row", "px_col"], "ndvi", ["nir"]),
        f"WITH {_ZO}, p AS (SELECT px_row, px_col, quantile_cont(ndvi, 0.25) AS a, quantile_cont(ndvi, 0.75) AS b FROM zo GROUP BY 1, 2) SELECT px_row, px_col, round(median(nir), 4) AS nir_median, round(median(nir) FILTER (WHERE ndvi <= a + 1e-9), 4) AS nir_dry, round(median(nir) FILTER (WHERE ndvi >= b - 1e-9), 4) AS nir_wet, round(min(nir), 4) AS nir_min, round(max(nir), 4) AS nir_max, round(max(nir) - min(nir), 4) AS nir_amp, round(stddev_pop(nir), 4) AS nir_std FROM zo JOIN p USING (px_row, px_col) GROUP BY 1, 2",
    ),
    "j2_quality_mosaic": (
        lambda s, d: cp.quality_mosaic(zobs(s, d), ["px_row", "px_col", "year"], "ndvi", ["nir", "red"], ["scene_id", "line", "nir", "red"]),
        f"WITH {_ZO} SELECT px_row, px_col, year, nir, red FROM (SELECT *, row_number() OVER (PARTITION BY px_row, px_col, year ORDER BY ndvi DESC, scene_id, line, nir, red) AS rk FROM zo) WHERE rk = 1",
    ),
    "j3_extreme_percentiles": (
        lambda s, d: cp.extremes(zobs(s, d), ["px_row", "px_col"], "ndvi", ["nir", "red"]),
        f"WITH {_ZO}, p AS (SELECT px_row, px_col, quantile_cont(ndvi, 0.25) AS a, quantile_cont(ndvi, 0.75) AS b FROM zo GROUP BY 1, 2) SELECT px_row, px_col, " + ", ".join(f"round(median({b}), 4) AS {b}_median, round(quantile_cont({b}, 0.01), 4) AS {b}_p1, round(quantile_cont({b}, 0.99), 4) AS {b}_p99, round(min({b}), 4) AS {b}_min, round(max({b}), 4) AS {b}_max, round(median({b}) FILTER (WHERE ndvi <= a + 1e-9), 4) AS {b}_median_p25, round(median({b}) FILTER (WHERE ndvi >= b - 1e-9), 4) AS {b}_median_p75" for b in ("nir", "red")) + " FROM zo JOIN p USING (px_row, px_col) GROUP BY 1, 2",
    ),
    "j4_dark_outliers": (lambda s, d: mk.dark_outlier_mask(images(s, d), ["year"], z=0.5, most=1.5, reach=1).where("tdomMask").select("px_row", "px_col", "year"), f"{_IMAGES} SELECT px_row, px_col, year FROM td WHERE tdom"),
    "j5_cast_shadows": (lambda s, d: all_masks(s, d).where("cloudShadowTdomMask").select("px_row", "px_col", "year"), f"{_IMAGES} SELECT px_row, px_col, year FROM sh WHERE shadow"),
    "j6_mask_methods": (
        lambda s, d: all_masks(s, d).groupBy("year").agg(F.count("*").alias("n"), *(F.count(F.when(F.col(m), 1)).alias(f"n_{m}") for m in mk.MASKS)),
        f"{_IMAGES} SELECT year, count(*) AS n, count(*) FILTER (WHERE cloud) AS n_cloudFlagMask, count(*) FILTER (WHERE {_SCORE} > 0.6) AS n_cloudScoreMask, count(*) FILTER (WHERE qa & 16 <> 0) AS n_cloudShadowFlagMask, count(*) FILTER (WHERE tdom) AS n_tdomMask, count(*) FILTER (WHERE shadow) AS n_cloudShadowTdomMask FROM sh GROUP BY 1",
    ),
    "j6_masked_observations": (
        lambda s, d: mk.apply_masks(all_masks(s, d)).groupBy("px_row", "px_col").agg(F.count("*").alias("n"), F.round(F.avg("nir"), 4).alias("nir")),
        f"{_IMAGES} SELECT px_row, px_col, count(*) AS n, round(avg(nir), 4) AS nir FROM sh WHERE NOT cloud AND {_SCORE} <= 0.6 AND qa & 16 = 0 AND NOT tdom AND NOT shadow GROUP BY 1, 2",
    ),
    "j6_brightness_alone": (
        lambda s, d: mk.apply_masks(all_masks(s, d, cloud_flag=False, cloud_score=False, shadow_flag=False, shadow_tdom=False)).groupBy("year").agg(F.count("*").alias("n"), F.round(F.avg("nir"), 4).alias("nir")),
        f"{_IMAGES} SELECT year, count(*) AS n, round(avg(nir), 4) AS nir FROM td WHERE {_SCORE} <= 0.6 AND NOT tdom GROUP BY 1",
    ),
    "j8_focal_mean": (
        lambda s, d: cp.focal_mean(modes(s, d).withColumn("v", F.col("mode_id") * F.col("mode_id")), "v", 2).select("px_row", "px_col", F.round("focal", 4).alias("focal")),
        f"{_W} SELECT a.px_row, a.px_col, round(avg(b.mode_id * b.mode_id), 4) AS focal FROM pxmode a JOIN pxmode b ON abs(a.px_row - b.px_row) <= 2 AND abs(a.px_col - b.px_col) <= 2 GROUP BY 1, 2",
    ),
    "j8_focal_entropy": (
        lambda s, d: cp.focal_entropy(modes(s, d), "mode_id", 1).select("px_row", "px_col", F.round("entropy", 4).alias("entropy")),
        f"{_W}, k AS (SELECT a.px_row, a.px_col, b.mode_id AS v, count(*) AS n FROM pxmode a JOIN pxmode b ON abs(a.px_row - b.px_row) <= 1 AND abs(a.px_col - b.px_col) <= 1 GROUP BY 1, 2, 3) SELECT px_row, px_col, round(-sum(p * log2(p)) + 0.0, 4) AS entropy FROM (SELECT px_row, px_col, n / sum(n) OVER (PARTITION BY px_row, px_col) AS p FROM k) GROUP BY 1, 2",
    ),
    "j8_slope_aspect": (
        lambda s, d: cp.slope_aspect(modes(s, d), "mode_id", 30.0),
        f"{_W}, g AS (SELECT a.px_row, a.px_col, count(*) AS n, sum((b.px_col - a.px_col) * CASE WHEN b.px_row = a.px_row THEN 2 ELSE 1 END * b.mode_id) / 240.0 AS dx, sum((b.px_row - a.px_row) * CASE WHEN b.px_col = a.px_col THEN 2 ELSE 1 END * b.mode_id) / 240.0 AS dy FROM pxmode a JOIN pxmode b ON abs(a.px_row - b.px_row) <= 1 AND abs(a.px_col - b.px_col) <= 1 GROUP BY 1, 2) SELECT px_row, px_col, round(degrees(atan(sqrt(dx * dx + dy * dy))), 4) AS slope, CASE WHEN dx <> 0 OR dy <> 0 THEN round((degrees(atan2(dx, -dy)) + 360) % 360, 4) END AS aspect FROM g WHERE n = 9",
    ),
}
