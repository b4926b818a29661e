"""Source, plan and audit queries over the driver tables, and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapanel.operators import panel as op
from terrapanel.operators import reviewplan as rp
from terrapanel.operators import yearplan as yp
from terrapanel.plans import panel_queries as pq
from terrapanel.plans import selection_queries as sq
from terrapanel.plans.grid_queries import OBS_SQL, obs
from terrapanel.plans.label_queries import _PQ, patches
from terrapanel.sources import adapters as ad
from terrapanel.sources import tables as tb
from terrapanel.sources.shared import table

_W = "WITH " + ad.SQL
_M = sq._M


_TYPES = [*rp.ANNUAL_TYPES[:1], *rp.STABLE_TYPES[:1], *rp.TRANSITION_TYPES[:1], *rp.PRESENCE_TYPES[:1], rp.FILLER_TYPE, rp.ANNUAL_TYPES[1], rp.STABLE_TYPES[1], rp.TRANSITION_TYPES[1], rp.PRESENCE_TYPES[1], "manual"]


def selection(s, d):
    """Cells as a selection: by their keys all types, with and without reference years, runs either way round, periods
    without a class and cells without a change."""
    years = pq._years(s, d)
    cells = op.longest_run(years).select("grid_id", "run_start", "run_end", F.expr("grid_id DIV 10").alias("k"), (F.col("grid_id") % 7 + 1).cast("int").alias("target_class"))
    ps = op.period_summary(ad.panel(s, d), ad.periods(s), years)
    every = cells.select("grid_id", "k", "target_class").crossJoin(F.broadcast(ad.periods(s))).join(ps, ["grid_id", "period"], "left")
    md = F.when((F.col("grid_id") + F.col("y0")) % 5 == 0, 0).when(F.col("k") % 4 == 1, F.col("target_class")).otherwise(F.col("md_id"))
    arr = every.groupBy("grid_id").agg(F.array_sort(F.collect_list(F.struct("y0", F.col("period").alias("p"), "y1", F.expr("CAST((y0 + y1) DIV 2 AS INT)").alias("mid"), md.cast("int").alias("md_id"), "md_pct", "n_stable"))).alias("periods"))
    kind = F.element_at(F.array(*map(F.lit, _TYPES)), (F.col("grid_id") % 10 + 1).cast("int"))
    ref = F.when(F.col("k") % 3 == 0, None).when(F.col("k") % 5 == 4, 1990).otherwise((1995 + F.col("grid_id") % 7).cast("int"))
    turned = F.col("k") % 4 == 3
    ends = [F.when(turned, F.col(x)).otherwise(F.col(y)).alias(y) for x, y in (("run_end", "run_start"), ("run_start", "run_end"))]
    return cells.join(arr, "grid_id").select("grid_id", kind.alias("sample_type"), ref.alias("ref_year"), "target_class", *ends, (F.col("k") % 3 * 2.0).alias("transition_pct"), (F.col("k") % 4 * 3).alias("max_stab_run"), "periods")


PERIODS = (("P1", 1995, 1996), ("P2", 1997, 1998), ("P3", 1999, 2000), ("P4", 2001, 2001))
MOST = (4, 3, 5)


def earlier_cells(s, d):
    """Cells for plans of the earlier generation: every kind of cell, with and without reference years, stable years and rare classes."""
    # The panel is read once, into a row for each pixel that all parts come from.
    history = table(op.pixel_history(ad.panel(s, d)), "history")
    long = history.select(*op.PIXEL, F.col("valid_mode_id").alias("mode_id"), F.explode("years").alias("y")).select(*op.PIXEL, "mode_id", "y.year", "y.class_id")
    years = table(op.year_shares(long, 0.4), "years")
    of_period = lambda y0, y1: F.array_join(F.array_sort(F.collect_list(F.when(F.col("stable") & F.col("year").between(y0, y1), F.col("year")))), ",")
    stable = years.groupBy("grid_id").agg(of_period(1995, 2001).alias("all_years"), *(of_period(a, b).alias(f"stb_yrs_{p}") for p, a, b in PERIODS))
    modes = op.period_summary(long, ad.periods(s), years).groupBy("grid_id").pivot("period", [p for p, _, _ in PERIODS]).agg(F.first("md_id"))
    g = F.col("grid_id")
    same = g % 8 == 2
    ids = {f"md_id_{p}": F.when(same, 3).otherwise(F.col(p)) for p, _, _ in PERIODS}
    cells = stable.join(modes, "grid_id").withColumns(ids).withColumns({f"md_nm_{p}": F.concat(F.lit("c"), F.col(f"md_id_{p}").cast("string")) for p, _, _ in PERIODS})
    return cells.select(
        g.cast("string").alias("grid_id"), F.element_at(F.array(F.lit("anual"), F.lit(" estable "), F.lit("transicion"), F.lit(None)), (g % 4 + 1).cast("int")).alias("dim_temporal"),
        F.when(g % 3 == 0, "anual_homogenea").when(g % 3 == 1, "estable_mixta").alias("sample_type"), F.when(g % 5 == 0, 1990).when(g % 5 == 1, None).otherwise((1995 + g % 7).cast("int")).alias("ref_year"),
        F.when(g % 16 == 10, "").otherwise(F.concat("all_years", F.lit(",2050,x"))).alias("stable_years"), F.when(g % 6 == 0, "c3").when(g % 6 == 1, "nan").alias("target_rare_class"), F.when(g % 6 == 2, 5).alias("target_rare_class_id"), F.when(g % 7 > 0, g % 7 - 1).alias("review_tier"),
        *ids, *(f"md_nm_{p}" for p, _, _ in PERIODS), *(f"stb_yrs_{p}" for p, _, _ in PERIODS),
    )


def earlier(s, d):
    return yp.earlier_plan(earlier_cells(s, d), PERIODS, MOST)


def national(s, d):
    """Three plans of different sources and columns as one."""
    # The cells' plan is worked out once, not for each of the three.
    p = table(earlier(s, d), "earlier").withColumn("g", F.col("grid_id").cast("int")).withColumn("split", F.when(F.col("g") % 2 == 0, "train")).withColumn("review_desc", F.when(F.col("g") % 9 == 0, yp.AUTOMATIC))
    return yp.national_plan({"plan_utm18.csv": p.where("g % 3 = 0").drop("split"), "plan_UTM19.csv": p.where("g % 3 = 1").withColumn("transition_pct", F.when(F.col("g") % 2 == 0, "7.5").otherwise("?")), "more.csv": p.where("g % 3 = 2").withColumn("utm", F.when(F.col("g") % 2 == 0, "UTM20")).drop("review_rule")})


def _thin(years: str, k: int) -> str:
    return f"(CASE WHEN len({years}) <= {k} THEN {years} ELSE list_sort(list_distinct([{years}[CAST(round_even(i * (len({years}) - 1) / {k - 1}, 0) AS INT) + 1] FOR i IN range({k})])) END)"


def _earlier_sql() -> str:
    """Each set of years by its rows, put into lists; every list is cut to the range and thinned where the plan does."""
    sort = lambda x: f"list_sort(list_distinct(list_filter({x}, lambda y: y BETWEEN 1995 AND 2001)))"
    near = lambda t, l: f"(SELECT y FROM (SELECT unnest({l}) AS y) ORDER BY abs(y - {t}), y LIMIT 1)"
    border = " || ".join(f"CASE WHEN coalesce(md_id_{a}, -9999) <> coalesce(md_id_{b}, -9999) THEN {list(range(y - 2, y + 2))} ELSE []::INT[] END" for (a, _, _), (b, y, _) in zip(PERIODS[:-1], PERIODS[1:]))
    rare = " || ".join(f"CASE WHEN (rare_id > 0 AND md_id_{p} = rare_id) OR (rare <> '' AND 'c' || md_id_{p} = rare) THEN CASE WHEN len(s_{p}) > 0 THEN [s_{p}[1], s_{p}[-1]] ELSE [{a}, {b}] END ELSE []::INT[] END" for p, a, b in PERIODS)
    return f"""{sq._PS_SQL}, ecs AS (SELECT grid_id, coalesce(list(CAST(year AS INT) ORDER BY year) FILTER (WHERE stable), []) AS all_years, {", ".join(f"coalesce(list(CAST(year AS INT) ORDER BY year) FILTER (WHERE stable AND year BETWEEN {a} AND {b}), []) AS s_{p}" for p, a, b in PERIODS)} FROM ys GROUP BY 1),
ecm AS (SELECT grid_id, {", ".join(f"CASE WHEN grid_id % 8 = 2 THEN 3 ELSE max(md_id) FILTER (WHERE period = '{p}') END AS md_id_{p}" for p, _, _ in PERIODS)} FROM ps GROUP BY 1),
ecq0 AS (SELECT *, ['anual', 'estable', 'transicion', ''][grid_id % 4 + 1] AS dim, CASE grid_id % 3 WHEN 0 THEN 'anual_homogenea' WHEN 1 THEN 'estable_mixta' END AS kind, CASE WHEN grid_id % 5 >= 2 THEN CAST(1995 + grid_id % 7 AS INT) END AS ref, CASE WHEN grid_id % 16 = 10 THEN [] ELSE all_years END AS stable, CASE WHEN grid_id % 6 = 0 THEN 'c3' ELSE '' END AS rare, CASE WHEN grid_id % 6 = 2 THEN 5 ELSE 0 END AS rare_id, CASE WHEN grid_id % 7 > 0 THEN grid_id % 7 - 1 ELSE 2 END AS tier FROM ecs JOIN ecm USING (grid_id)),
ecq1 AS (SELECT *, {sort(border)} AS w0, CASE WHEN len(stable) > 0 THEN {sort("flatten([[y - 1, y, y + 1] FOR y IN list_filter(range(1995, 2002), lambda z: NOT list_contains(stable, z))])")} ELSE [] END AS u0, {sort(rare)} AS r0,
  CASE WHEN len(stable) = 0 THEN [1995, 1999, 2001] ELSE {sort(f"[CASE WHEN list_contains(stable, 1995) THEN 1995 ELSE {near(1997, 'stable')} END, CASE WHEN list_contains(stable, 1999) THEN 1999 ELSE {near(1999, 'stable')} END, list_max(stable)]")} END AS anchors, {near(2001, "stable")} AS late FROM ecq0),
ecq2 AS (SELECT *, {_thin("w0", MOST[0])} AS w, {_thin("u0", MOST[0])} AS u, {_thin("r0", MOST[1])} AS r FROM ecq1),
ecq3 AS (SELECT *, CASE WHEN dim = 'anual' THEN CASE WHEN ref IS NOT NULL THEN [ref] WHEN late IS NOT NULL THEN [late] ELSE [] END WHEN dim <> 'transicion' THEN anchors WHEN len(w) > 0 THEN w WHEN len(u) > 0 THEN u ELSE [1995, 1996, 1998, 2000, 2001] END AS base,
  CASE WHEN dim = 'anual' THEN CASE WHEN ref IS NULL AND late IS NOT NULL THEN 'anual_fallback_stable_year' ELSE 'anual_ref_year' END WHEN dim = 'estable' THEN 'estable_anclas_temporales' WHEN dim = '' THEN 'fallback_anclas_temporales' WHEN len(w) > 0 THEN 'transicion_cambio_modal_entre_periodos' WHEN len(u) > 0 THEN 'transicion_anios_no_estables' ELSE 'transicion_sin_anio_exacto_usar_anclas' END AS rule FROM ecq2),
ecq4 AS (SELECT *, list_sort(list_distinct(base || r)) AS b0 FROM ecq3),
ecq5 AS (SELECT *, CASE WHEN len(r) > 0 THEN {_thin("b0", MOST[2])} ELSE base END AS whole FROM ecq4),
ep AS (SELECT CAST(grid_id AS INT) AS g, array_to_string(whole, ',') AS review_years, len(whole) AS n_review_years, rule AS review_rule, CAST(CASE WHEN rare <> '' OR dim = 'transicion' OR kind = 'anual_homogenea' THEN least(tier, 1) ELSE tier END AS INT) AS review_priority,
  array_to_string(list_filter([CASE WHEN dim = 'anual' AND ref IS NULL THEN 'anual_sin_ref_year_valido' END, CASE WHEN dim = '' THEN 'dim_temporal_no_reconocida' END, CASE WHEN whole <> base THEN 'incluye_anios_clase_rara' END], lambda x: x IS NOT NULL), ';') AS review_notes, whole, dim, kind, rare, grid_id FROM ecq5)"""


_EARLIER = _earlier_sql()
_NATIONAL_PLAN = _EARLIER + """, np AS (SELECT *, CASE g % 3 WHEN 0 THEN 'UTM18' WHEN 1 THEN 'UTM19' ELSE CASE WHEN g % 2 = 0 THEN 'UTM20' ELSE 'UTM' END END AS utm, ['plan_utm18.csv', 'plan_UTM19.csv', 'more.csv'][g % 3 + 1] AS fuente_plan, CASE WHEN g % 3 = 2 THEN 'sin_regla' ELSE review_rule END AS the_rule,
  CASE WHEN g % 3 <> 0 AND g % 2 = 0 THEN 'train' ELSE 'sin_split' END AS split, CASE WHEN g % 3 = 1 AND g % 2 = 0 THEN 7.5 ELSE 0.0 END AS transition_pct, ['anual', ' estable ', 'transicion', 'sin_dim_temporal'][g % 4 + 1] AS dim_temporal, coalesce(kind, 'sin_tipo') AS sample_type, CASE WHEN g % 6 = 1 THEN 'nan' ELSE rare END AS target_rare_class FROM ep)"""


def plan(s, d):
    return rp.review_years(selection(s, d), year_min=1995, year_max=2001)


_ANY = "(" + ", ".join(f"'{t}'" for t in _TYPES) + ")"
_SEL = sq._PS_SQL + f""", {pq._RUNS},
sl AS (SELECT grid_id, [{_ANY[1:-1]}][grid_id % 10 + 1] AS sample_type, CASE WHEN k % 3 = 0 THEN NULL WHEN k % 5 = 4 THEN 1990 ELSE CAST(1995 + grid_id % 7 AS INT) END AS ref_year, CAST(grid_id % 7 + 1 AS INT) AS target_class,
  least(coalesce(run_start, 1995), coalesce(run_end, 2001)) AS a, greatest(coalesce(run_start, 1995), coalesce(run_end, 2001)) AS b, k % 3 * 2.0 AS tr, k % 4 * 3 AS stab, k FROM (SELECT *, grid_id // 10 AS k FROM lr)),
p4 AS (SELECT sl.grid_id, y0, y1, (y0 + y1) // 2 AS mid, CASE WHEN (sl.grid_id + y0) % 5 = 0 THEN 0 WHEN k % 4 = 1 THEN target_class ELSE md_id END AS md_id, coalesce(CAST(md_pct AS DOUBLE), 0) AS md_pct, coalesce(n_stable, 0) AS n_stable, target_class FROM sl CROSS JOIN periods p LEFT JOIN ps ON ps.grid_id = sl.grid_id AND ps.period = p.period),
md AS (SELECT *, lead(md_id) OVER w AS next_id, lead(y0) OVER w AS next_y0, lead(mid) OVER w AS next_mid, lead(md_pct) OVER w AS next_pct FROM p4 WHERE md_id IS NOT NULL AND md_id NOT IN (0, -9999) WINDOW w AS (PARTITION BY grid_id ORDER BY y0)),
chg AS (SELECT grid_id, arg_min(mid, y0) AS before, arg_min(next_y0, y0) AS during, arg_min(next_mid, y0) AS after FROM md WHERE next_id <> md_id GROUP BY 1),
jmp AS (SELECT grid_id, next_mid AS jump FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY abs(md_pct - next_pct) DESC, y0) AS rk FROM md WHERE next_id IS NOT NULL) WHERE rk = 1),
bst AS (SELECT grid_id, mid AS best FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY md_pct DESC, y0) AS rk FROM md WHERE md_id = target_class) WHERE rk = 1),
big AS (SELECT grid_id, mid AS largest FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY md_pct DESC, y0) AS rk FROM p4) WHERE rk = 1),
stb AS (SELECT grid_id, mid AS steady FROM (SELECT *, row_number() OVER (PARTITION BY grid_id ORDER BY n_stable DESC, y0) AS rk FROM p4) WHERE rk = 1),
ctl AS (SELECT grid_id, mid AS control FROM (SELECT sl.grid_id, p.mid, row_number() OVER (PARTITION BY sl.grid_id ORDER BY abs(p.y0 - o.y0) DESC, p.y0) AS rk
  FROM sl JOIN periods o ON (a + b) // 2 BETWEEN o.y0 AND o.y1 JOIN (SELECT *, (y0 + y1) // 2 AS mid FROM periods) p ON p.period <> o.period AND p.mid BETWEEN a AND b WHERE a < b) WHERE rk = 1),
an AS (SELECT *, (a + b) // 2 AS yr, CASE WHEN sample_type LIKE 'anual%' THEN 'A' WHEN sample_type LIKE 'estable%' THEN 'E' WHEN sample_type LIKE 'transicion%' THEN 'T' WHEN sample_type LIKE 'presencia%' THEN 'P'
  WHEN sample_type = 'relleno_presupuesto' AND tr > 3 THEN 'T' WHEN sample_type = 'relleno_presupuesto' AND stab >= 6 THEN 'E' ELSE 'S' END AS rule
  FROM sl LEFT JOIN chg USING (grid_id) LEFT JOIN jmp USING (grid_id) LEFT JOIN bst USING (grid_id) LEFT JOIN big USING (grid_id) LEFT JOIN stb USING (grid_id) LEFT JOIN ctl USING (grid_id)),
pl AS (SELECT grid_id, sample_type, CAST(CASE rule WHEN 'A' THEN CASE WHEN ref_year >= 1995 THEN ref_year ELSE 2001 END WHEN 'E' THEN yr WHEN 'T' THEN coalesce(during, ref_year, jump, 2001)
    WHEN 'P' THEN coalesce(best, CASE WHEN ref_year BETWEEN 1995 AND 2001 THEN ref_year END, largest) ELSE steady END AS INT) AS rev_year1,
  CASE rule WHEN 'A' THEN 'anual' WHEN 'E' THEN 'ancla' WHEN 'T' THEN 'durante_cambio' ELSE 'representativo_clase' END AS rev_role1,
  CAST(coalesce(CASE rule WHEN 'E' THEN control WHEN 'T' THEN before END, -9999) AS INT) AS rev_year2,
  CASE WHEN rule = 'E' AND control IS NOT NULL THEN 'control_sensor' WHEN rule = 'T' AND before IS NOT NULL THEN 'antes' ELSE '' END AS rev_role2,
  CAST(coalesce(CASE rule WHEN 'T' THEN after END, -9999) AS INT) AS rev_year3, CASE WHEN rule = 'T' AND after IS NOT NULL THEN 'despues' ELSE '' END AS rev_role3,
  CASE WHEN sample_type = 'relleno_presupuesto' THEN 'relleno_por_composicion' WHEN rule = 'A' THEN 'ref_year_directo' WHEN rule = 'E' THEN 'estable_ancla_control'
    WHEN rule = 'T' THEN CASE WHEN during IS NULL THEN 'transicion_fallback_sin_cambio_periodo' ELSE 'transicion_md_periodos' END
    WHEN rule = 'P' THEN CASE WHEN best IS NULL THEN 'censo_refuerzo_fallback' ELSE 'censo_refuerzo_periodo_dominante' END ELSE 'tipo_desconocido_fallback' END AS rev_metodo,
  CAST(CASE WHEN rule = 'T' AND during IS NOT NULL THEN 3 WHEN rule = 'E' AND control IS NOT NULL THEN 2 ELSE 1 END AS INT) AS rev_n_years FROM an),
lg AS (SELECT grid_id, 1 AS slot, rev_year1 AS year, rev_role1 AS role FROM pl UNION ALL SELECT grid_id, 2, rev_year2, rev_role2 FROM pl WHERE rev_year2 <> -9999 UNION ALL SELECT grid_id, 3, rev_year3, rev_role3 FROM pl WHERE rev_year3 <> -9999)"""
_COLS = ["grid_id", "sample_type", "rev_year1", "rev_role1", "rev_year2", "rev_role2", "rev_year3", "rev_role3", "rev_n_years", "rev_metodo"]


def _rules(s, d):
    from terrapanel.operators.labels import constraint_report

    y1, y2 = F.col("rev_year1"), F.col("rev_year2")
    return constraint_report(plan(s, d), "grid_id", {"out_of_range": ("error", ~y1.between(1996, 2000)), "duplicate_year": ("error", y1 == y2), "no_second_year": ("warning", (y2 == rp.NONE) & F.col("sample_type").isin(*rp.STABLE_TYPES, *rp.TRANSITION_TYPES))})


def audits(s, d):
    """An audit log of units (customers) from their orders."""
    return ad.table(s, d, "orders").select(F.col("o_custkey").alias("unit"), F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "P", "empty").otherwise("failed").alias("status"), F.col("o_orderkey").alias("seq"))


_AU = "au AS (SELECT o_custkey AS unit, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'P' THEN 'empty' ELSE 'failed' END AS status, o_orderkey AS seq FROM orders), la AS (SELECT unit, status, seq FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY seq DESC) AS rk FROM au) WHERE rk = 1)"


def k12(s, d):
    m = op.temporal_mode(ad.panel(s, d)).join(ad.zone(s, d).where("eco_id > 0"), ["px_row", "px_col"]).where("mode_id not in (0, 8)")
    by = lambda x: x.groupBy("eco_id", F.col("mode_id").alias("class_id")).agg(F.sum("area").alias("ha"))
    return rp.coverage_audit(by(m), by(m.where("grid_id % 5 <> 0")), by(m.where("grid_id % 5 = 1")), ["eco_id", "class_id"])


def runs(s, d):
    """Indicators of yearly runs: orders and their sum by status."""
    o = ad.table(s, d, "orders").groupBy(F.year("o_orderdate").cast("string").alias("run_id"), F.col("o_orderstatus").alias("name")).agg(F.count("*").cast("double").alias("value"))
    return o


_MODE_SQL = "SELECT sat FROM (SELECT px_row % 3 AS sat, count(*) AS n FROM obs GROUP BY 1)"

QUERIES = {
    "a5_normalise_scale": (
        lambda s, d: sq.metrics(s, d).select("grid_id", F.when(F.col("grid_id") % 2 == 0, "2x2").otherwise("3x3").alias("grid_mode"), F.coalesce(F.col("dominant_eco_id"), F.lit(0)).alias("eco_id"), (F.col("grid_id") % 10 >= 5).alias("east")),
        f"{_M} SELECT grid_id, CASE WHEN grid_id % 2 = 0 THEN '2x2' ELSE '3x3' END AS grid_mode, eco AS eco_id, grid_id % 10 >= 5 AS east FROM mt",
    ),
    "a6_two_scales": (
        lambda s, d: tb.two_scales(tb.numeric(sq.metrics(s, d).select("grid_id", F.col("dominant_eco_id").alias("eco_id"), F.when(F.col("grid_id") % 3 == 0, "x").otherwise(F.col("total").cast("string")).alias("v")), ["v"]).where("grid_id % 2 = 0"), sq.metrics(s, d).select("grid_id", F.col("dominant_eco_id").alias("eco_id")).where("grid_id % 2 = 1"), "eco_id"),
        f"{_M} SELECT grid_id, eco AS eco_id, CASE WHEN grid_id % 2 = 0 THEN CASE WHEN grid_id % 3 = 0 THEN 0.0 ELSE CAST(total AS DOUBLE) END END AS v, CASE WHEN grid_id % 2 = 0 THEN 2 ELSE 3 END AS side FROM mt WHERE eco > 0",
    ),
    "a7_field_defaults": (lambda s, d: tb.canonical(patches(s, d), {"grid_id": [], "status": ["poly_qa"], "sensor": ["sat"]}).select("grid_id", F.coalesce("status", F.lit("pending")).alias("status"), F.coalesce(F.col("sensor").cast("string"), F.lit("L8")).alias("sensor")).groupBy("status", "sensor").agg(F.count("*").alias("n")), f"WITH {_PQ} SELECT coalesce(poly_qa, 'pending') AS status, 'L8' AS sensor, count(*) AS n FROM pq GROUP BY 1"),
    "a8_canonical_columns": (
        lambda s, d: tb.as_percent(tb.canonical(ad.table(s, d, "lineitem"), {"segment": ["L_SUPPKEY"], "share": ["pct", "l_discount"]}), "share").groupBy("segment").agg(F.round(F.avg("share"), 4).alias("share")),
        "SELECT l_suppkey AS segment, round(avg(l_discount * 100), 4) AS share FROM lineitem GROUP BY 1",
    ),
    "a9_duplicate_keys": (lambda s, d: tb.duplicate_keys(ad.table(s, d, "lineitem"), "l_partkey", "l_returnflag"), "SELECT l_partkey, count(DISTINCT l_returnflag) AS n_files FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1"),
    "a10_shard_union": (
        lambda s, d: ad.panel(s, d).select(F.expr("px_row % 10").alias("r"), "px_col", "year", F.expr("CAST(px_row DIV 10 AS INT)").alias("shard"), "class_id").join(F.broadcast(ad.panel(s, d).select(F.expr("CAST(px_row DIV 10 AS INT)").alias("shard")).distinct().withColumn("row_off", F.col("shard") * 10)), "shard").select((F.col("r") + F.col("row_off")).alias("px_row"), "px_col", "year", "class_id"),
        f"{_W} SELECT px_row, px_col, year, class_id FROM panel",
    ),
    "a11_parse_parameters": (
        lambda s, d: ad.table(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("t")).select("o_orderkey", tb.parse_date(F.col("t")).alias("d")),
        "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders",
    ),
    "a12_consolidate": (
        lambda s, d: op.class_shares(op.temporal_mode(ad.panel(s, d))).groupBy("grid_id").pivot("class_id", [1, 2, 3]).agg(F.first("pct")).na.fill(0.0).select("grid_id", *(F.col(f"`{k}`").alias(f"pct_{k}") for k in (1, 2, 3))),
        f"{_W}, k AS (SELECT grid_id, class_id, round(100.0 * ha / sum(ha) OVER (PARTITION BY grid_id), 4) AS pct FROM cell_class WHERE class_id NOT IN (0, 8)) SELECT grid_id, " + ", ".join(f"coalesce(max(CASE WHEN class_id = {k} THEN pct END), 0) AS pct_{k}" for k in (1, 2, 3)) + " FROM k GROUP BY 1",
    ),
    "a13_pending_units": (lambda s, d: rp.pending_units(ad.table(s, d, "customer").select(F.col("c_custkey").alias("unit")), audits(s, d), ["unit"], "seq"), f"WITH {_AU} SELECT c_custkey AS unit FROM customer WHERE c_custkey NOT IN (SELECT unit FROM la WHERE status IN ('complete', 'empty'))"),
    "a14_run_summary": (
        lambda s, d: ad.table(s, d, "customer").select(F.col("c_custkey").alias("unit")).join(rp.latest(audits(s, d), ["unit"], "seq"), "unit", "full_outer").groupBy(F.coalesce("status", F.lit("missing")).alias("status")).agg(F.count("*").alias("n")),
        f"WITH {_AU} SELECT coalesce(status, 'missing') AS status, count(*) AS n FROM customer FULL JOIN la ON unit = c_custkey GROUP BY 1",
    ),
    "a16_manifest_upsert": (
        lambda s, d: rp.upsert(rp.latest(audits(s, d).where("seq % 2 = 0"), ["unit"], "seq"), rp.latest(audits(s, d).where("seq % 2 = 1"), ["unit"], "seq"), ["unit"]),
        "WITH au AS (SELECT o_custkey AS unit, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'P' THEN 'empty' ELSE 'failed' END AS status, o_orderkey AS seq FROM orders) SELECT unit, status, seq FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY seq % 2 DESC, seq DESC) AS rk FROM au) WHERE rk = 1",
    ),
    "a17_export_names": (lambda s, d: tb.export_names(plan(s, d).select("grid_id", "sample_type", "rev_year1"), {"sample_type": "smp_type", "rev_year1": "rev_y1"}), f"{_SEL} SELECT grid_id, sample_type AS smp_type, rev_year1 AS rev_y1 FROM pl"),
    "e17_parse_years": (
        lambda s, d: ad.table(s, d, "lineitem").groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_set(F.year("l_shipdate").cast("string"))), ", ").alias("t")).select("l_suppkey", F.array_join(rp.thin_years(tb.parse_years(F.col("t"), 1996, 2001), 3).cast("array<string>"), ",").alias("years")),
        "WITH y AS (SELECT l_suppkey, list_sort(list(DISTINCT CAST(year(l_shipdate) AS INT))) AS ys FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2001 GROUP BY 1) SELECT l_suppkey, array_to_string(CASE WHEN len(ys) <= 3 THEN ys ELSE [ys[1], ys[CAST(round_even((len(ys) - 1) / 2, 0) AS INT) + 1], ys[len(ys)]] END, ',') AS years FROM y",
    ),
    "e18_key_parsing": (lambda s, d: ad.table(s, d, "supplier").select("s_suppkey", F.regexp_extract("s_name", "#0*([0-9]+)$", 1).alias("number"), F.format_string("%05d_%s", F.col("s_nationkey"), F.lower(F.substring("s_name", 1, 4))).alias("uid")), "SELECT s_suppkey, regexp_extract(s_name, '#0*([0-9]+)$', 1) AS number, printf('%05d_%s', s_nationkey, lower(substr(s_name, 1, 4))) AS uid FROM supplier"),
    "f2_matrix_with_budget": (
        lambda s, d: sq.matrix(s, d).join(s.createDataFrame([(e, c, "censo") for e in range(1, 6) for c in (1, 3)], "eco_id int, class_id int, mode string"), ["eco_id", "class_id"], "left"),
        f"{_W}, {sq._MX} SELECT eco_id, class_id, ha, CASE WHEN class_id IN (1, 3) THEN 'censo' END AS mode FROM mx",
    ),
    "f4_exclude_ids": (lambda s, d: ad.table(s, d, "customer").select("c_custkey").join(ad.table(s, d, "orders").where("o_orderkey % 9 = 0").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti"), "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 9 = 0)"),
    "d14_scene_filters": (lambda s, d: obs(s, d).where("year between 1996 and 1999").join(obs(s, d).where("qa = 7").select("scene_id").distinct(), "scene_id", "left_anti").groupBy("year").agg(F.count("*").alias("n")), f"WITH {OBS_SQL} SELECT year, count(*) AS n FROM obs WHERE year BETWEEN 1996 AND 1999 AND scene_id NOT IN (SELECT scene_id FROM obs WHERE qa = 7) GROUP BY 1"),
    "k1_review_years": (lambda s, d: plan(s, d).select(*_COLS), f"{_SEL} SELECT " + ", ".join(_COLS) + " FROM pl"),
    "k2_validate_plan": (_rules, f"{_SEL} SELECT 'out_of_range' AS rule, 'error' AS severity, CAST(grid_id AS VARCHAR) AS key FROM pl WHERE rev_year1 NOT BETWEEN 1996 AND 2000 UNION ALL SELECT 'duplicate_year', 'error', CAST(grid_id AS VARCHAR) FROM pl WHERE rev_year1 = rev_year2 UNION ALL SELECT 'no_second_year', 'warning', CAST(grid_id AS VARCHAR) FROM pl WHERE rev_year2 = -9999 AND (sample_type LIKE 'estable%' OR sample_type LIKE 'transicion%')"),
    "k3_long_plan": (lambda s, d: rp.long_plan(plan(s, d)), f"{_SEL} SELECT * FROM lg"),
    "k4_merged_years": (lambda s, d: rp.merged_years(rp.long_plan(plan(s, d))), f"{_SEL} SELECT grid_id, year, arg_min(role, slot) AS role, array_to_string(list_sort(list(slot)), ',') AS slots FROM lg GROUP BY 1, 2"),
    "k7_plan_summary": (lambda s, d: rp.long_plan(plan(s, d)).rollup("role").agg(F.count("*").alias("n"), F.count_distinct("grid_id").alias("n_cells")).select(F.coalesce("role", F.lit("TOTAL")).alias("role"), "n", "n_cells"), f"{_SEL} SELECT coalesce(role, 'TOTAL') AS role, count(*) AS n, count(DISTINCT grid_id) AS n_cells FROM lg GROUP BY ROLLUP (role)"),
    "k8_expand_groups": (
        lambda s, d: selection(s, d).select("grid_id", F.explode(F.array_compact(F.array(F.col("sample_type"), F.when(F.col("target_class") == 3, "rare"), F.when(F.col("target_class").isin(4, 5), "crosscut")))).alias("label_group")),
        f"{_SEL} SELECT grid_id, sample_type AS label_group FROM an UNION ALL SELECT grid_id, 'rare' FROM an WHERE target_class = 3 UNION ALL SELECT grid_id, 'crosscut' FROM an WHERE target_class IN (4, 5)",
    ),
    "k9_set_operations": (
        lambda s, d: ad.table(s, d, "lineitem").where("year(l_shipdate) = 1996").select("l_partkey").intersect(ad.table(s, d, "lineitem").where("year(l_shipdate) = 1997").select("l_partkey")).exceptAll(ad.table(s, d, "lineitem").where("year(l_shipdate) = 1998").select("l_partkey").distinct()),
        "SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1996 INTERSECT SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1997 EXCEPT SELECT l_partkey FROM lineitem WHERE year(l_shipdate) = 1998",
    ),
    "k10_crosstab": (lambda s, d: rp.crosstab(patches(s, d).withColumn("poly_qa", F.coalesce("poly_qa", F.lit("pending"))), "class_id", "poly_qa", ["approved", "rejected", "pending"]), f"WITH {_PQ} SELECT coalesce(CAST(class_id AS VARCHAR), 'TOTAL') AS class_id, count(*) FILTER (WHERE poly_qa = 'approved') AS approved, count(*) FILTER (WHERE poly_qa = 'rejected') AS rejected, count(*) FILTER (WHERE poly_qa IS NULL) AS pending, count(*) AS \"TOTAL\" FROM pq GROUP BY ROLLUP (class_id)"),
    "k11_class_summary": (lambda s, d: op.area_by_class(op.temporal_mode(ad.panel(s, d))).where("class_id in (3, 7)").groupBy("class_id").agg(F.count("*").alias("n_cells"), F.sum("ha").alias("ha"), F.max("ha").alias("most")), f"{_W} SELECT class_id, count(*) AS n_cells, CAST(sum(ha) AS BIGINT) AS ha, CAST(max(ha) AS BIGINT) AS most FROM cell_class WHERE class_id IN (3, 7) GROUP BY 1"),
    "k12_coverage_audit": (
        k12,
        f"{_W}, m AS (SELECT * FROM pxmode JOIN zone USING (px_row, px_col) WHERE eco_id > 0 AND mode_id NOT IN (0, 8)), a AS (SELECT eco_id, mode_id AS class_id, CAST(sum(area) AS BIGINT) AS ha, CAST(coalesce(sum(area) FILTER (WHERE grid_id % 5 <> 0), 0) AS BIGINT) AS candidate_ha, CAST(coalesce(sum(area) FILTER (WHERE grid_id % 5 = 1), 0) AS BIGINT) AS captured_ha FROM m GROUP BY 1, 2), p AS (SELECT *, round(coalesce(100.0 * captured_ha / nullif(candidate_ha, 0), 0), 4) AS attainable_pct, round(100.0 * captured_ha / ha, 4) AS absolute_pct FROM a) SELECT *, CASE WHEN candidate_ha = 0 THEN 'no_candidates' WHEN attainable_pct >= 80 THEN 'covered' WHEN captured_ha > 0 THEN 'partial' ELSE 'missing' END AS state FROM p",
    ),
    "k16_compare_runs": (
        lambda s, d: rp.compare_runs(runs(s, d), "1996"),
        "WITH r AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS run_id, o_orderstatus AS name, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2), b AS (SELECT name, value AS base_value FROM r WHERE run_id = '1996') SELECT name, run_id, value, base_value, value - base_value AS delta, round(value / base_value, 4) AS ratio FROM (SELECT * FROM r WHERE run_id <> '1996') FULL JOIN b USING (name)",
    ),
    "k17_filter_funnel": (
        lambda s, d: sq.sel.funnel(sq.metrics(s, d), {"valid": F.col("valid_pct") >= 75, "pure": F.col("dominant_pct") >= 35, "few": F.col("n_classes") <= 6}),
        f"{_M} SELECT 0 AS step, 'valid' AS name, count(*) FILTER (WHERE valid_pct >= 75) AS n FROM mt UNION ALL SELECT 1, 'pure', count(*) FILTER (WHERE valid_pct >= 75 AND dominant_pct >= 35) FROM mt UNION ALL SELECT 2, 'few', count(*) FILTER (WHERE valid_pct >= 75 AND dominant_pct >= 35 AND n_classes <= 6) FROM mt",
    ),
    "k18_representation": (lambda s, d: ad.panel(s, d).groupBy("year").agg(F.count_distinct("grid_id").alias("n_cells"), F.count("*").alias("n_px"), (F.count("*") < 1000).alias("low")), f"{_W} SELECT year, count(DISTINCT grid_id) AS n_cells, count(*) AS n_px, count(*) < 1000 AS low FROM panel GROUP BY 1"),
    "k19_label_summary": (lambda s, d: patches(s, d).groupBy("class_id").agg(F.count("*").alias("n"), F.count_distinct("grid_id").alias("n_rects"), F.sum("area_ha").alias("ha")), f"WITH {_PQ} SELECT class_id, count(*) AS n, count(DISTINCT grid_id) AS n_rects, CAST(sum(area_ha) AS BIGINT) AS ha FROM pq GROUP BY 1"),
    "k20_sensor_by_year": (
        lambda s, d: obs(s, d).groupBy("year").agg(F.mode(F.col("qa") % 3, True).alias("sensor")).withColumn("sensor", F.when(F.col("year") < 1997, 5).otherwise(F.col("sensor"))),
        f"WITH {OBS_SQL} SELECT year, CASE WHEN year < 1997 THEN 5 ELSE k END AS sensor FROM (SELECT year, qa % 3 AS k, row_number() OVER (PARTITION BY year ORDER BY count(*) DESC, qa % 3) AS rk FROM obs GROUP BY 1, 2) WHERE rk = 1",
    ),
    "k5_earlier_plan": (lambda s, d: earlier(s, d).select(F.col("grid_id").cast("int").alias("grid_id"), "review_years", "n_review_years", "review_rule", "review_priority", "review_notes"), _EARLIER + " SELECT g AS grid_id, review_years, n_review_years, review_rule, review_priority, review_notes FROM ep"),
    "k6_national_plan": (
        lambda s, d: yp.manual_list(national(s, d)).select("utm", "grid_id", "sample_type", "dim_temporal", "review_years", "review_rule", "review_priority", "split", "target_rare_class", "transition_pct", "lulc_mode_id", "review_tier", "fuente_plan"),
        _NATIONAL_PLAN + " SELECT utm, CAST(g AS VARCHAR) AS grid_id, sample_type, dim_temporal, review_years, the_rule AS review_rule, review_priority, split, target_rare_class, transition_pct, -9999 AS lulc_mode_id, CASE WHEN g % 7 > 0 THEN g % 7 - 1 ELSE 3 END AS review_tier, fuente_plan FROM np",
    ),
    "k6_plan_by_year": (lambda s, d: yp.plan_by_year(national(s, d)).select("utm", "grid_id", "year", "review_rule", "ref_year", "split"), _NATIONAL_PLAN + " SELECT utm, CAST(g AS VARCHAR) AS grid_id, unnest(whole) AS year, the_rule AS review_rule, CASE g % 5 WHEN 0 THEN 1990 WHEN 1 THEN -9999 ELSE 1995 + g % 7 END AS ref_year, split FROM np"),
    "k6_plan_summary": (lambda s, d: yp.plan_summary(national(s, d)), _NATIONAL_PLAN + " SELECT utm, count(*) AS n, count(*) FILTER (WHERE len(whole) > 0) AS n_with_years, CAST(sum(len(whole)) AS BIGINT) AS n_years, count(*) FILTER (WHERE target_rare_class <> '') AS n_rare, count(*) FILTER (WHERE g % 9 = 0) AS n_auto FROM np GROUP BY 1"),
}
