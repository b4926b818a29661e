"""The selection over all zones, its audits and its acceptance rules over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapanel.operators import acceptance, lattice, national
from terrapanel.plans import selection_queries as sq
from terrapanel.plans.grid_queries import _BOX, _PAIR, boxes
from terrapanel.sources import adapters as ad
from terrapanel.sources.shared import table

#: Pools in order: who is in, who passes, the quota in a zone of ``n`` cells.
POOLS = {
    "stable": ("id % 3 = 0", "id % 7 <> 0", "n // 12"),
    "annual": ("id % 2 = 0", "id % 7 <> 0", "n // 10"),
    "transition": ("id % 11 = 0 AND zone <> 2", "id % 7 <> 0", "n // 40 + 1"),
    "arid": ("id % 5 = 0", "zone <> 3 AND side = 3", "n // 50 + 1"),
    "filler": ("TRUE", "id % 13 <> 0", "NULL"),
}
WANTED, SHARE = {c: 60.0 for c in range(1, 7)}, 0.10


def cells(s, d):
    """Boxes of five zones with a class, an amount, a side and a rank each."""
    p = ad.table(s, d, "part")
    return p.select(F.col("p_partkey").alias("id"), F.expr("1 + (p_size DIV 2) % 5").cast("long").alias("zone"), (F.col("p_partkey") % 9).alias("class_id"), (F.col("p_partkey") % 40 + 1).alias("amount"), (2 + F.col("p_size") % 2).alias("side"), F.expr("(p_partkey * 2654435761 + 17) % 4294967296").alias("rank"))


def candidates(s, d):
    member = [F.when(F.expr(who), F.struct(F.lit(p).alias("pool"), F.expr(passes).alias("passes"))) for p, (who, passes, _) in POOLS.items()]
    return cells(s, d).withColumn("m", F.explode(F.array_compact(F.array(*member)))).select("zone", "m.pool", "id", "m.passes", "class_id", "amount", "side", "rank")


def zones(s, d):
    """Zones, smallest first."""
    counts = cells(s, d).groupBy("zone").agg(F.count("*").alias("n")).orderBy("n", "zone").collect()
    size = {"stable": lambda n: n // 12, "annual": lambda n: n // 10, "transition": lambda n: n // 40 + 1, "arid": lambda n: n // 50 + 1}
    return [national.Zone(r["zone"], [(p, f(r["n"])) for p, f in size.items()], r["n"] // 4, WANTED) for r in counts]


def log(s, d):
    return national.select_nationally(candidates(s, d), sq.conflicts(s, d), zones(s, d), SHARE)


def quotas(s, d):
    """The quota of each pool, and of fillers what the zone still lacks."""
    zs = zones(s, d)
    own = s.createDataFrame([(z.zone, p, q) for z in zs for p, q in z.quotas] + [(z.zone, "most", z.most) for z in zs], "zone long, pool string, quota long")
    return own


def with_lacks(log_, quotas_):
    """``quotas`` whose rows of pool ``most`` become the fillers' quota: the most cells of the zone less what its pools took."""
    n = log_.where("decision = 'picked' AND pool <> 'filler'").groupBy("zone").agg(F.count("*").alias("n_zone"))
    whole = quotas_.where("pool = 'most'").join(n, "zone", "left").select("zone", F.lit("filler").alias("pool"), F.greatest(F.lit(0).cast("long"), F.col("quota") - F.coalesce("n_zone", F.lit(0))).alias("quota"))
    return quotas_.where("pool <> 'most'").unionByName(whole)


def _sql() -> str:
    """The walk, zone by zone: each zone's pools entry by entry, then its filler; ``lg`` has all decisions."""
    pools = list(POOLS)
    member = " UNION ALL ".join(f"SELECT *, '{p}' AS pool, {k} AS pool_no, {passes} AS passes FROM cell WHERE {who}" for k, (p, (who, passes, _)) in enumerate(POOLS.items()))
    quota = "CASE pool " + " ".join(f"WHEN '{p}' THEN {q}" for p, (_, _, q) in POOLS.items() if p != "filler") + " END"
    ctes = [
        _BOX, _PAIR,
        "cf AS MATERIALIZED (SELECT id, list(other) AS others FROM (SELECT a AS id, b AS other FROM pr WHERE area > 0 UNION ALL SELECT b, a FROM pr WHERE area > 0) GROUP BY 1)",
        "cell AS MATERIALIZED (SELECT p_partkey AS id, CAST(1 + (p_size // 2) % 5 AS BIGINT) AS zone, p_partkey % 9 AS class_id, p_partkey % 40 + 1 AS amount, 2 + p_size % 2 AS side, (p_partkey * 2654435761 + 17) % 4294967296 AS rank, coalesce(others, []) AS others FROM part LEFT JOIN cf ON cf.id = p_partkey)",
        "zo AS MATERIALIZED (SELECT zone, count(*) AS n, row_number() OVER (ORDER BY count(*), zone) AS z FROM cell GROUP BY 1)",
        f"en AS MATERIALIZED (SELECT e.*, z, {quota} AS quota FROM ({member}) e JOIN zo USING (zone))",
        "t0 AS (SELECT []::BIGINT[] AS taken, 0::BIGINT AS n_all, 0::BIGINT AS n_filled)",
    ]
    judge = "CASE WHEN (CASE WHEN o.pool = w.pool THEN w.n ELSE 0 END) >= o.quota THEN o.full_ WHEN list_contains(w.taken, o.id) THEN 'picked_before' WHEN list_has_any(o.others, w.taken) THEN 'blocked' ELSE 'picked' END"

    def walk(name: str, rows: str, start: str) -> str:
        step = f"SELECT o.k, o.pool, o.id, {judge} AS what, w.taken, CASE WHEN o.pool = w.pool THEN w.n ELSE 0 END AS n, o.others FROM {name} w JOIN {rows} o ON o.k = w.k + 1"
        return f"""{name}(k, pool, id, what, hit, taken, n) AS (SELECT 0::BIGINT, ''::VARCHAR, NULL::BIGINT, ''::VARCHAR, NULL::BIGINT, (SELECT taken FROM {start}), 0::BIGINT
  UNION ALL SELECT k, pool, id, what, CASE what WHEN 'picked_before' THEN id WHEN 'blocked' THEN list_filter(taken, lambda x: list_contains(others, x))[1] END, CASE WHEN what = 'picked' THEN list_append(taken, id) ELSE taken END, n + CASE WHEN what = 'picked' THEN 1 ELSE 0 END FROM ({step}))"""

    for z in range(1, 6):
        ctes += [
            f"o{z} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY pool_no, rank) AS k, pool, id, quota, others, 'quota_full' AS full_ FROM en WHERE z = {z} AND passes AND pool <> 'filler')",
            walk(f"w{z}", f"o{z}", f"t{z - 1}"),
            f"p{z} AS MATERIALIZED (SELECT w{z}.*, class_id, amount FROM w{z} JOIN cell USING (id) WHERE what = 'picked')",
            f"m{z} AS MATERIALIZED (SELECT (SELECT taken FROM w{z} ORDER BY k DESC LIMIT 1) AS taken, (SELECT count(*) FROM p{z}) AS n_zone, (SELECT n_all FROM t{z - 1}) + (SELECT count(*) FROM p{z}) AS n_all, (SELECT n_filled FROM t{z - 1}) AS n_filled, (SELECT n // 4 FROM zo WHERE z = {z}) AS most)",
            f"r{z} AS MATERIALIZED (SELECT *, greatest(0, most - n_zone) AS lacks, greatest(0, CAST(floor({SHARE} / (1 - {SHARE}) * n_all + 1e-9) AS BIGINT) - n_filled) AS room FROM m{z})",
            f"g{z} AS MATERIALIZED (SELECT class_id, sum(amount) AS got FROM p{z} GROUP BY 1)",
            f"f{z} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY CASE side WHEN 3 THEN 0 ELSE 1 END, CASE WHEN en.class_id NOT BETWEEN 1 AND 6 OR coalesce(got, 0) >= 60 THEN 2 WHEN coalesce(got, 0) > 0 THEN 1 ELSE 0 END, rank) AS k, pool, id, least(lacks, room) AS quota, others, CASE WHEN room < lacks THEN 'national_cap' ELSE 'quota_full' END AS full_ FROM en LEFT JOIN g{z} g ON g.class_id = en.class_id, r{z} WHERE z = {z} AND passes AND pool = 'filler')",
            walk(f"v{z}", f"f{z}", f"m{z}"),
            f"t{z} AS MATERIALIZED (SELECT (SELECT taken FROM v{z} ORDER BY k DESC LIMIT 1) AS taken, n_all, n_filled + (SELECT count(*) FROM v{z} WHERE what = 'picked') AS n_filled FROM m{z})",
        ]
    all_ = " UNION ALL ".join(f"SELECT {z} AS z, * FROM w{z} WHERE k > 0 UNION ALL SELECT {z}, * FROM v{z} WHERE k > 0" for z in range(1, 6))
    ctes.append(f"lg AS MATERIALIZED (SELECT zone, pool, id, what AS decision, hit AS \"by\", CASE WHEN what = 'picked' THEN CAST(n AS INT) END AS place FROM ({all_}) JOIN (SELECT zone, z FROM zo) USING (z) UNION ALL SELECT zone, pool, id, 'filtered', NULL, NULL FROM en WHERE NOT passes)")
    lacks = " UNION ALL ".join(f"SELECT {z} AS z, 'filler' AS pool, CAST(lacks AS BIGINT) AS quota FROM r{z}" for z in range(1, 6))
    ctes.append(f"qt AS (SELECT zone, pool, quota FROM (SELECT zone, pool, CAST({quota} AS BIGINT) AS quota FROM zo, (SELECT unnest({pools[:-1]}) AS pool)) UNION ALL SELECT zone, pool, quota FROM ({lacks}) JOIN zo USING (z))")
    ctes.append("""df AS (SELECT *, greatest(0, quota - n_picked) AS deficit, CASE WHEN quota <= n_picked THEN 'none' WHEN n_candidates = 0 THEN 'empty_pool' WHEN n_filtered = n_candidates THEN 'filtered' WHEN n_capped > 0 THEN 'national_cap' WHEN n_picked = 0 THEN 'none_free' ELSE 'exhausted' END AS cause
  FROM (SELECT q.zone, q.pool, q.quota, count(id) AS n_candidates, count(*) FILTER (WHERE decision = 'filtered') AS n_filtered, count(*) FILTER (WHERE decision = 'picked') AS n_picked, count(*) FILTER (WHERE decision = 'picked_before') AS n_picked_before, count(*) FILTER (WHERE decision = 'blocked') AS n_blocked, count(*) FILTER (WHERE decision = 'national_cap') AS n_capped
  FROM qt q LEFT JOIN lg ON lg.zone = q.zone AND lg.pool = q.pool GROUP BY ALL))""")
    return "WITH RECURSIVE " + ", ".join(ctes)


_NATIONAL = _sql()
_AUDIT = "CAST(sum(n_picked) AS BIGINT) AS n_picked, CAST(sum(CASE WHEN pool = 'filler' THEN n_picked ELSE 0 END) AS BIGINT) AS n_filler, CAST(sum(CASE WHEN pool <> 'filler' THEN deficit ELSE 0 END) AS BIGINT) AS deficit, CAST(sum(CASE WHEN pool = 'filler' THEN deficit ELSE 0 END) AS BIGINT) AS unassigned, count(*) FILTER (WHERE n_picked = 0) AS n_empty_pools"


def _with_log(run):
    def query(s, d):
        found = table(log(s, d), "log")
        return run(found, with_lacks(found, quotas(s, d)))

    return query



def selection(s, d, found):
    """The picks with what the rules ask for."""
    c = cells(s, d).select("id", "class_id", "side", F.col("amount").alias("ha"))
    split = F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 < 9, "val").otherwise("test")
    mode = F.when(F.col("pool") == "stable", "census").when(F.col("pool") == "arid", "reinforcement").otherwise("standard")
    return national.picks(found).join(c, "id").select("zone", "pool", "id", F.col("class_id").alias("target_class"), split.alias("split"), F.floor(F.col("id") / 3).alias("cluster"), (F.col("zone") == 4).alias("unfeasible"), "side", mode.alias("mode"), "ha")


def run_tables(s, d):
    """The tables of a run: no file of layers, no report, and a universe with classes that aren't allowed."""
    picked = table(selection(s, d, log(s, d)), "selection")
    where = picked.join(boxes(s, d), picked["id"] == F.col("box_id")).select("box_id", "x0", "y0", "x1", "y1", "zone", "split")
    pairs = lattice.overlaps(where.select("box_id", "x0", "y0", "x1", "y1"), where.select("box_id", "x0", "y0", "x1", "y1"), 4, True)
    ends = pairs.join(where.select(F.col("box_id").alias("a"), "zone", F.col("split").alias("split_a")), "a").join(where.select(F.col("box_id").alias("b"), F.col("zone").alias("zone_b"), F.col("split").alias("split_b")), "b")
    sums = where.agg(F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("sum_area"))
    over = pairs.where("area > 0").agg(F.coalesce(F.sum("area"), F.lit(0)).alias("twice"), F.count("*").alias("n_pairs"))
    own = picked.groupBy("zone", F.col("target_class").alias("class_id"), "mode").agg(F.sum("ha").alias("own"))
    there = cells(s, d).where("class_id > 2").groupBy("zone", "class_id").agg(F.sum("amount").alias("whole"))
    return {
        "universe": cells(s, d).select("zone", "class_id"),
        "selection": picked.drop("pool"),
        "grid": cells(s, d).select("side"),
        "leaks": ends.where("zone = zone_b AND split_a <> split_b").groupBy("zone").agg(F.count("*").alias("n")),
        "coverage": own.join(there, ["zone", "class_id"], "left").select("mode", (F.col("own") / F.col("whole")).alias("share")),
        "overlap": sums.crossJoin(over).select("sum_area", (F.col("sum_area") - F.col("twice")).alias("union_area"), "n_pairs"),
    }


def rules():
    census = F.col("mode") == "census"
    return [*acceptance.selection_rules(), acceptance.within("B1", "Census cells", "selection", ["mode"], census, 1), acceptance.within("B2", "Cells of side 3 in census", "selection", ["mode", "side"], census & (F.col("side") == 3), 0, 1), acceptance.within("B3", "Cells of the first tier", "selection", ["review_tier"], F.lit(True), 1)]


_RUN = """, sl AS MATERIALIZED (SELECT lg.zone, pool, id, class_id, CASE WHEN id % 10 < 7 THEN 'train' WHEN id % 10 < 9 THEN 'val' ELSE 'test' END AS split, id // 3 AS cluster, lg.zone = 4 AS unfeasible, side, CASE pool WHEN 'stable' THEN 'census' WHEN 'arid' THEN 'reinforcement' ELSE 'standard' END AS mode, amount AS ha FROM lg JOIN cell USING (id) WHERE decision = 'picked'),
lk AS (SELECT x.zone, count(*) AS n FROM pr JOIN sl x ON x.id = pr.a JOIN sl y ON y.id = pr.b WHERE x.zone = y.zone AND x.split <> y.split GROUP BY 1),
zs AS (SELECT zone, bool_or(unfeasible) AS off, count(DISTINCT cluster) FILTER (WHERE split = 'val') AS n_val, count(DISTINCT cluster) FILTER (WHERE split = 'test') AS n_test, count(*) FILTER (WHERE split = 'train') AS n_train, count(*) AS n FROM sl GROUP BY 1),
cv AS (SELECT mode, own / whole AS share FROM (SELECT zone, class_id, mode, sum(ha) AS own FROM sl GROUP BY ALL) LEFT JOIN (SELECT zone, class_id, sum(amount) AS whole FROM cell WHERE class_id > 2 GROUP BY ALL) USING (zone, class_id)),
ov AS (SELECT (SELECT sum((x1 - x0) * (y1 - y0)) FROM box JOIN sl ON id = box_id) AS s, (SELECT coalesce(sum(area), 0) FROM pr WHERE area > 0 AND a IN (SELECT id FROM sl) AND b IN (SELECT id FROM sl)) AS o, (SELECT count(*) FROM pr WHERE area > 0 AND a IN (SELECT id FROM sl) AND b IN (SELECT id FROM sl)) AS n)"""


def _acceptance_sql() -> str:
    """One SELECT for each rule: its value, whether that passes, and the detail."""
    listed = lambda fails, said, t="zs": f"(SELECT coalesce(string_agg('E' || zone || ':' || {said}, '; ' ORDER BY 'E' || zone || ':' || {said}), '') FROM {t} WHERE {fails})"
    zones = lambda fails, said, t="zs": (f"(SELECT count(*) FROM {t} WHERE {fails})", "= 0", listed(fails, said, t))
    percent = lambda x: f"floor(1000 * {x} + 0.5) / 10 || ' %'"
    count = lambda where, t="sl": f"(SELECT count(*) FROM {t} WHERE {where})"
    own, whole = "(SELECT avg(CASE WHEN side = 3 THEN 1 ELSE 0 END) FROM sl)", "(SELECT avg(CASE WHEN side = 3 THEN 1 ELSE 0 END) FROM cell)"
    values = {
        "1": (count("class_id IN (0, 27, 9, 11, 18, 19, 24, 30, 36, 73, 74, 75, 79, 80, 26, 33, 34, 35)", "cell"), "= 0", "''"),
        "2": (count("class_id = 0"), "= 0", "''"),
        "CRS18": "layers", "CRS19": "layers",
        "7": zones("n > 0", "n", "lk"),
        "8": zones("NOT off AND (n_val < 2 OR n_test < 2)", "'val=' || n_val || ' test=' || n_test"),
        "12": zones("NOT off AND n_train / n < 0.5", percent("n_train / n")),
        "13": zones("n_train = 0", "'0'"),
        "15": "selection.pool",
        "16": (f"round(abs({own} - {whole}), 4)", "<= 0.15", f"'selection ' || {percent(own)} || ', universe ' || {percent(whole)}"),
        "17": (count("mode IN ('census', 'reinforcement') AND ha < 50 - 1e-6"), "= 0", "''"),
        "18": (count("mode IN ('census', 'reinforcement') AND share IS NULL", "cv"), "= 0", "''"),
        "A1": (count("share > 1.0001", "cv"), "= 0", "''"),
        "21": ("(SELECT round(o / greatest(s - o, 1e-9), 6) FROM ov)", "<= 0.001", "''"),
        "22": ("(SELECT n FROM ov)", "= 0", "''"),
        "24": "report",
        "B1": (count("mode = 'census'"), ">= 1", "''"),
        "B2": (count("mode = 'census' AND side = 3"), "BETWEEN 0 AND 1", "''"),
        "B3": "selection.review_tier",
    }
    parts = [f"SELECT '{k}' AS test, NULL::DOUBLE AS value, 'NOT-EVALUABLE' AS result, 'missing: {v}' AS detail" if isinstance(v, str) else f"SELECT '{k}', CAST({v[0]} AS DOUBLE), CASE WHEN {v[0]} {v[1]} THEN 'PASS' ELSE 'FAIL' END, {v[2]}" for k, v in values.items()]
    return _NATIONAL + _RUN + " SELECT * FROM (" + " UNION ALL ".join(sorted(parts, key=lambda p: "NULL" not in p)) + ")"


QUERIES = {
    "g10_filler": (lambda s, d: log(s, d).where("pool = 'filler'"), _NATIONAL + " SELECT * FROM lg WHERE pool = 'filler'"),
    "g11_select_in_phases": (log, _NATIONAL + " SELECT * FROM lg"),
    "k13_deficits": (_with_log(national.deficits), _NATIONAL + " SELECT zone, pool, quota, n_candidates, n_filtered, n_picked, n_picked_before, n_blocked, n_capped, deficit, cause FROM df"),
    "k13_zone_audit": (_with_log(national.zone_audit), _NATIONAL + f" SELECT zone, {_AUDIT} FROM df GROUP BY 1 UNION ALL SELECT -1, {_AUDIT} FROM df"),
    "k15_acceptance": (lambda s, d: acceptance.evaluate(s, run_tables(s, d), rules()).drop("description", "criterion"), _acceptance_sql()),
}
