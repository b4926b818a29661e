"""Filling, reserve, rare-class, repair and split queries over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapanel.operators import topup
from terrapanel.plans import audit_queries as aq
from terrapanel.plans import selection_queries as sq
from terrapanel.plans.grid_queries import _BOX, _PAIR
from terrapanel.plans.national_queries import cells
from terrapanel.sources.shared import table

LIMITS = topup.Limits(run_homogeneous=6, run_simple=4, share_homogeneous=60, share_simple=(30, 60), change_homogeneous=4, change_simple=6, diversity=1.2, classes_simple=(2, 5), stable_share=50, years_homogeneous=2, years_simple=2, change=9, classes_change=4, share_change=50)
LEAST, PRIORITY, MAX_ADD, BARE, BARE_ZONES, WATER, TARGET = 22, (2, 4), 20, 2, (1, 2, 3), 7, 130


def samples(s, d):
    """Cells with measures of all kinds; a few of them are selected already."""
    i = F.col("id")
    return cells(s, d).select(
        "id", "zone", "class_id", (F.col("side") == 3).alias("mixed"), (i * 31 % 97).alias("score"), (i % 13).alias("transition_pct"), F.array(*((F.floor(i / k) % 3).cast("int") for k in (1, 3, 9, 27))).alias("stable_years"),
        F.when(i % 17 == 0, "rare").alias("rare"), (i % 5 == 0).alias("exempt"), F.element_at(F.array(*map(F.lit, ("estable", "anual", "transicion"))), (i % 3 + 1).cast("int")).alias("dim_temporal"), (i % 29 == 0).alias("selected"),
        (i % 9).alias("max_run"), (i * 7 % 101).alias("mode_pct"), (i % 20 / 10).alias("diversity"), (i % 7).alias("n_classes"), (i * 3 % 100).alias("stable_pct"),
    )


def parts(s, d):
    whole = samples(s, d)
    selected = whole.where("selected").select("id", "zone", "class_id", "dim_temporal")
    return selected, topup.fill_candidates(whole, selected, BARE, BARE_ZONES, WATER), sq.conflicts(s, d)


def zone_minimum(s, d):
    selected, free, conflicts = parts(s, d)
    return topup.fill_zone_minimum(selected, free, conflicts, LEAST, PRIORITY, MAX_ADD, BARE)


def to_total(s, d):
    """After the zones' minimum, up to the total."""
    selected, free, conflicts = parts(s, d)
    added = table(topup.fill_zone_minimum(selected, free, conflicts, LEAST, PRIORITY, MAX_ADD, BARE), "added")
    whole = selected.select("id", "zone").unionByName(added.select("id", "zone"))
    return topup.fill_to_total(whole, free.join(added.select("id"), "id", "left_anti"), conflicts, TARGET)


_SAMPLES = f"""{_BOX}, {_PAIR}, cf AS MATERIALIZED (SELECT id, list(other) AS others FROM (SELECT a AS id, b AS other FROM pr WHERE area > 0 UNION ALL SELECT b, a FROM pr WHERE area > 0) GROUP BY 1),
sa AS MATERIALIZED (SELECT p_partkey AS id, CAST(1 + (p_size // 2) % 5 AS BIGINT) AS zone, p_partkey % 9 AS class_id, p_size % 2 = 1 AS mixed, p_partkey * 31 % 97 AS score, p_partkey % 13 AS tr, [p_partkey % 3, p_partkey // 3 % 3, p_partkey // 9 % 3, p_partkey // 27 % 3] AS st, p_partkey % 17 = 0 AS rare, p_partkey % 5 = 0 AS exempt,
  ['estable', 'anual', 'transicion'][p_partkey % 3 + 1] AS dim, p_partkey % 29 = 0 AS selected, p_partkey % 9 AS max_run, p_partkey * 7 % 101 AS mode_pct, p_partkey % 20 / 10 AS diversity, p_partkey % 7 AS n_classes, p_partkey * 3 % 100 AS stable_pct, coalesce(others, []) AS others FROM part LEFT JOIN cf ON cf.id = p_partkey)"""
_FREE = f"""{_SAMPLES}, fr AS MATERIALIZED (SELECT *, CASE WHEN tr >= 8 THEN 'transicion' WHEN list_max(st) >= 2 THEN 'anual' ELSE 'estable' END AS kind FROM sa WHERE NOT selected AND NOT (zone IN {BARE_ZONES} AND class_id = {BARE} AND NOT exempt) AND NOT (class_id = {WATER} AND NOT rare)),
se AS (SELECT id FROM sa WHERE selected), zn AS (SELECT z.zone, coalesce(n, 0) AS n, row_number() OVER (ORDER BY z.zone NOT IN {PRIORITY}, coalesce(n, 0), z.zone) AS k FROM (SELECT DISTINCT zone FROM fr UNION SELECT unnest({list(PRIORITY)}::BIGINT[])) z LEFT JOIN (SELECT zone, count(*) AS n FROM sa WHERE selected GROUP BY 1) USING (zone)),
en AS MATERIALIZED (SELECT row_number() OVER (ORDER BY k, 2 * (kind NOT IN (SELECT dim FROM sa x WHERE x.selected AND x.zone = fr.zone))::INT + (class_id NOT IN (SELECT x.class_id FROM sa x WHERE x.selected AND x.zone = fr.zone))::INT - (class_id = {BARE})::INT DESC, mixed DESC, score DESC, id) AS pos, id, k, {LEAST} - n AS need, others FROM fr JOIN zn USING (zone) WHERE n < {LEAST} AND NOT list_has_any(others, (SELECT list(id) FROM se))),
wk(pos, taken, k, n, last) AS (SELECT 0::BIGINT, []::BIGINT[], 0::BIGINT, 0::BIGINT, NULL::BIGINT UNION ALL SELECT pos, CASE WHEN ok THEN list_append(taken, id) ELSE taken END, k, n + ok::INT, CASE WHEN ok THEN id END FROM (
  SELECT e.pos, w.taken, e.k, e.id, CASE WHEN e.k = w.k THEN w.n ELSE 0 END AS n, CASE WHEN e.k = w.k THEN w.n ELSE 0 END < e.need AND len(w.taken) < {MAX_ADD} AND NOT list_has_any(e.others, w.taken) AS ok FROM wk w JOIN en e ON e.pos = w.pos + 1)),
ad AS MATERIALIZED (SELECT last AS id, n AS place FROM wk WHERE last IS NOT NULL)"""
_MINIMUM = f"WITH RECURSIVE {_FREE} SELECT id, zone, CAST(place AS INT) AS place, kind || '_simple_media' AS sample_type, kind AS dim_temporal, 'simple_media' AS dim_espacial FROM ad JOIN fr USING (id)"
_TOTAL = f"""WITH RECURSIVE {_FREE}, tk AS (SELECT id FROM se UNION ALL SELECT id FROM ad), nd AS (SELECT greatest(0, {TARGET} - count(*)) AS need FROM tk),
e2 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY mixed DESC, score DESC, id) AS pos, id, others FROM fr WHERE id NOT IN (SELECT id FROM tk) AND NOT list_has_any(others, (SELECT list(id) FROM tk))),
w2(pos, taken, last) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT UNION ALL SELECT pos, CASE WHEN ok THEN list_append(taken, id) ELSE taken END, CASE WHEN ok THEN id END FROM (SELECT e.pos, w.taken, e.id, len(w.taken) < (SELECT need FROM nd) AND NOT list_has_any(e.others, w.taken) AS ok FROM w2 w JOIN e2 e ON e.pos = w.pos + 1)),
a2 AS (SELECT last AS id, row_number() OVER (ORDER BY pos) AS place FROM w2 WHERE last IS NOT NULL)
SELECT id, zone, CAST(place AS INT) AS place, kind || CASE WHEN kind = 'transicion' OR mixed THEN '_simple_media' ELSE '_homogenea' END AS sample_type, kind AS dim_temporal, CASE WHEN kind = 'transicion' OR mixed THEN 'simple_media' ELSE 'homogenea' END AS dim_espacial FROM a2 JOIN fr USING (id)"""


def rare(s, d):
    """Cells of a rare class, three a zone and thirty in all; two zones have a bonus."""
    pool = samples(s, d).where("rare is not null").withColumn("strength", F.col("score") + F.when(F.col("zone").isin(1, 2), 40).otherwise(0))
    return topup.rare_class_pick(pool, [F.desc("strength"), F.asc("id")], 3, 30, LIMITS).select("id", "zone", "strength", "topped_up", "sample_type")


_RARE = f"""WITH {_SAMPLES}, po AS (SELECT *, score + CASE WHEN zone IN (1, 2) THEN 40 ELSE 0 END AS strength, list_filter(list_reverse(st), lambda x: x >= 1)[1] AS best FROM sa WHERE rare),
r1 AS (SELECT id FROM (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY strength DESC, id) AS rk FROM po) WHERE rk <= 3 ORDER BY strength DESC, id LIMIT 30),
r2 AS (SELECT id FROM (SELECT *, row_number() OVER (ORDER BY strength DESC, id) AS rk FROM po WHERE id NOT IN (SELECT id FROM r1)) WHERE rk <= 30 - (SELECT count(*) FROM r1)), al AS (SELECT id, FALSE AS topped_up FROM r1 UNION ALL SELECT id, TRUE FROM r2)
SELECT id, zone, strength, topped_up, CASE WHEN tr >= 9 THEN CASE WHEN n_classes >= 4 AND mode_pct < 50 THEN 'transicion_simple_media' ELSE 'transicion_homogenea' END WHEN NOT mixed AND best >= 2 THEN 'anual_homogenea' WHEN best >= 2 THEN 'anual_simple_media' WHEN NOT mixed AND max_run >= 6 AND mode_pct >= 60 AND diversity <= 1.2 THEN 'estable_homogenea' ELSE 'estable_simple_media' END AS sample_type FROM al JOIN po USING (id)"""


def repaired(s, d):
    """Cells with their stable years by period, of all types, repaired in the order of their ids."""
    c = aq.earlier_cells(s, d)
    g = F.col("grid_id").cast("int")
    of = lambda p: F.transform(F.filter(F.split(F.col(f"stb_yrs_{p}"), ","), lambda y: y != ""), lambda y: y.cast("int"))
    rows = c.select(
        g.alias("id"), F.element_at(F.array(*map(F.lit, ("anual_homogenea", "anual_simple_media", "anual_homogenea", "estable_simple_media", "anual_simple_media"))), (g % 5 + 1).cast("int")).alias("sample_type"), F.when(g % 5 == 3, "estable").otherwise("anual").alias("dim_temporal"), F.when(g % 5 % 2 == 0, F.when(g % 5 == 4, "simple_media").otherwise("homogenea")).otherwise("simple_media").alias("dim_espacial"),
        (g % 2 == 0).alias("mixed"), (g % 9).alias("max_run"), (g * 7 % 101).alias("mode_pct"), (g % 8).alias("transition_pct"), (g * 3 % 100).alias("stable_pct"), (g % 20 / 10).alias("diversity"), (g % 7).alias("n_classes"), F.lit(1990).alias("ref_year"),
        F.when(g % 6 == 5, F.array(*(F.array().cast("array<int>") for _ in range(4)))).otherwise(F.array(*(of(p) for p, _, _ in aq.PERIODS))).alias("years"),
    )
    return topup.repair_labels(rows, [F.asc("id")], LIMITS).select("id", "sample_type", "dim_temporal", "dim_espacial", "ref_year")


_REPAIRED = f"""WITH RECURSIVE {sq._PS_SQL.removeprefix("WITH ")}, sp AS (SELECT grid_id, [{", ".join(f"coalesce(list(CAST(year AS INT) ORDER BY year) FILTER (WHERE stable AND year BETWEEN {a} AND {b}), [])" for _, a, b in aq.PERIODS)}] AS years FROM ys GROUP BY 1),
r0 AS (SELECT CAST(grid_id AS INT) AS id, grid_id % 5 AS f, grid_id % 2 = 0 AS mixed, grid_id % 9 AS max_run, grid_id * 7 % 101 AS mode_pct, grid_id % 8 AS tr, grid_id * 3 % 100 AS stable_pct, grid_id % 20 / 10 AS diversity, grid_id % 7 AS n_classes, CASE WHEN grid_id % 6 = 5 THEN [[], [], [], []]::INT[][] ELSE years END AS years FROM sp),
r1 AS MATERIALIZED (SELECT *, f IN (0, 2) AND max_run >= 6 AND mode_pct >= 60 AND tr <= 4 AND stable_pct >= 50 AS early, list_sum([ord(x) FOR x IN string_split(CAST(id AS VARCHAR), '')]) AS letters, [list_sort(flatten(list_filter(years, lambda p: len(p) >= 2))), list_sort(flatten(list_filter(years, lambda p: len(p) >= 1)))] AS sets FROM r0),
r2 AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY id) AS pos, CASE WHEN len(sets[1]) > 0 THEN sets[1] ELSE sets[2] END AS cands FROM r1 WHERE NOT early AND f <> 3),
fo(pos, used, year) AS (SELECT 0::BIGINT, []::INT[], NULL::INT UNION ALL SELECT pos, CASE WHEN y IS NULL THEN used ELSE list_append(used, y) END, y FROM (
  SELECT pos, used, CASE WHEN len(cands) = 0 THEN NULL WHEN len(used) = 0 THEN list_max(cands) ELSE ties[CAST(letters % len(ties) AS INT) + 1] END AS y FROM (
    SELECT *, list_filter(cands, lambda c: len(list_filter(used, lambda u: u = c)) = few) AS ties FROM (
      SELECT r.pos, f.used, r.cands, r.letters, list_min([len(list_filter(f.used, lambda u: u = c)) FOR c IN r.cands]) AS few FROM fo f JOIN r2 r ON r.pos = f.pos + 1)))),
r3 AS (SELECT r1.*, year, r2.pos IS NOT NULL AS asked FROM r1 LEFT JOIN r2 ON r2.id = r1.id LEFT JOIN fo ON fo.pos = r2.pos),
r4 AS (SELECT *, CASE WHEN early THEN 'estable_homogenea' WHEN asked AND year IS NULL THEN CASE WHEN NOT mixed AND max_run >= 6 AND mode_pct >= 60 AND tr <= 4 AND diversity <= 1.2 THEN 'estable_homogenea' WHEN max_run >= 4 AND mode_pct >= 30 AND mode_pct < 60 AND n_classes BETWEEN 2 AND 5 AND tr <= 6 THEN 'estable_simple_media' END END AS up FROM r3)
SELECT id, coalesce(up, ['anual_homogenea', 'anual_simple_media', 'anual_homogenea', 'estable_simple_media', 'anual_simple_media'][f + 1]) AS sample_type, CASE WHEN up IS NOT NULL OR f = 3 THEN 'estable' ELSE 'anual' END AS dim_temporal,
  CASE WHEN up = 'estable_homogenea' THEN 'homogenea' WHEN up IS NOT NULL THEN 'simple_media' WHEN f IN (0, 2) THEN 'homogenea' ELSE 'simple_media' END AS dim_espacial, CASE WHEN up IS NOT NULL THEN -9999 WHEN asked THEN year ELSE 1990 END AS ref_year FROM r4 WHERE NOT (asked AND year IS NULL AND up IS NULL)"""


def split(s, d):
    """The cells of the panel, by rare class or by kind in time and zone."""
    kind = F.when(F.col("transition_pct") >= 60, "transicion").when(F.col("max_run") < 3, "anual").otherwise("estable")
    stratum = F.when(F.col("dominant_class_id").isin(3, 7), "rare:rare").otherwise(F.concat_ws("|eco:", kind, F.col("dominant_eco_id").cast("string")))
    return topup.stratified_split(sq.metrics(s, d).withColumn("stratum", stratum), ["stratum"], "grid_id", F.expr("(grid_id * 2654435761 + 9) % 4294967296"))


_SPLIT = f"""{sq._M}, u AS (SELECT grid_id, CASE WHEN dominant_class_id IN (3, 7) THEN 'rare:rare' ELSE CASE WHEN transition_pct >= 60 THEN 'transicion' WHEN max_run < 3 THEN 'anual' ELSE 'estable' END || '|eco:' || eco END AS stratum FROM mt), v AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY (grid_id * 2654435761 + 9) % 4294967296, grid_id) AS place, count(*) OVER (PARTITION BY stratum) AS n FROM u),
w AS (SELECT *, CASE WHEN n = 1 THEN 0 WHEN n = 2 THEN 1 ELSE greatest(1, round_even(n * 0.15::DOUBLE, 0)) END AS va, CASE WHEN n <= 2 THEN 0 ELSE greatest(1, round_even(n * 0.15::DOUBLE, 0)) END AS te FROM v)
SELECT stratum, grid_id, CASE WHEN place <= greatest(1, n - va - te) THEN 'train' WHEN place <= greatest(1, n - va - te) + va THEN 'val' ELSE 'test' END AS split FROM w"""

QUERIES = {
    "g12_rare_class_pick": (rare, _RARE),
    "g14_zone_minimum": (zone_minimum, _MINIMUM),
    "g14_fill_to_total": (to_total, _TOTAL),
    "g15_reserves": (lambda s, d: (lambda p: topup.reserves(p[0].where("zone <> 3 OR id % 58 = 0"), p[1], (1, 3, 5), 4, 9))(parts(s, d)), f"WITH {_SAMPLES}, sl AS (SELECT id, zone FROM sa WHERE selected AND (zone <> 3 OR id % 58 = 0)), ok AS (SELECT z AS zone FROM (SELECT unnest([1, 3, 5]::BIGINT[]) AS z) WHERE (SELECT count(*) FROM sl WHERE sl.zone = z) <= 9) SELECT id, zone, place FROM (SELECT id, zone, CAST(row_number() OVER (PARTITION BY zone ORDER BY mixed DESC, score DESC, id) AS INT) AS place FROM sa JOIN ok USING (zone) WHERE NOT selected AND NOT (zone IN {BARE_ZONES} AND class_id = {BARE} AND NOT exempt) AND NOT (class_id = {WATER} AND NOT rare)) WHERE place <= 4"),
    "g16_label_repair": (repaired, _REPAIRED),
    "h3_stratified_split": (split, _SPLIT),
}
