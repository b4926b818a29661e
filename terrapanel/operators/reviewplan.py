"""Review years, plans and audits of a selection.

``periods`` of a cell is an array of ``struct<y0, p, y1, mid, md_id, md_pct, n_stable>``, one for each
period in order of time; ``md_id`` is null, 0 or -9999 where the period has no dominant class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NONE = -9999

# Sample types, roles and methods as users of the plan compare them.
ANNUAL_TYPES = ("anual_homogenea", "anual_simple_media")
STABLE_TYPES = ("estable_homogenea", "estable_simple_media")
TRANSITION_TYPES = ("transicion_homogenea", "transicion_simple_media")
PRESENCE_TYPES = ("presencia_censo", "presencia_refuerzo")
FILLER_TYPE = "relleno_presupuesto"
ROLES = ("anual", "ancla", "control_sensor", "durante_cambio", "antes", "despues", "representativo_clase")
METHODS = (
    "ref_year_directo", "estable_ancla_control", "transicion_md_periodos", "transicion_fallback_sin_cambio_periodo", "censo_refuerzo_periodo_dominante", "censo_refuerzo_fallback",
    "relleno_por_composicion", "tipo_desconocido_fallback",
)
ANNUAL, ANCHOR, CONTROL, DURING, BEFORE, AFTER, REPRESENTATIVE = ROLES


def _plan(method: str, first: tuple, second: tuple = (None, ""), third: tuple = (None, "")) -> Column:
    """A plan of up to three (year, role); a slot without a year has no role."""
    fields = []
    for k, (year, role) in enumerate((first, second, third), 1):
        known = F.lit(NONE) if year is None else F.coalesce(year, F.lit(NONE))
        fields += [known.cast("int").alias(f"rev_year{k}"), F.when(known != NONE, F.lit(role)).otherwise("").alias(f"rev_role{k}")]
    return F.struct(*fields, F.lit(method).alias("rev_metodo"))


def _first_most(ps: Column, score) -> Column:
    """The ``mid`` of the element with the highest score, the first of equals; null of an empty array."""
    return F.array_max(F.transform(ps, lambda p, i: F.struct(score(p).alias("score"), (-i).alias("first"), p["mid"].alias("mid"))))["mid"]


def review_years(cells: DataFrame, year_min: int = 1999, year_max: int = 2024, transition_pct: float = 3.0, stable_run: int = 6) -> DataFrame:
    """Up to three review years of each cell by its ``sample_type``: ``rev_year1..3, rev_role1..3, rev_n_years, rev_metodo``.

    Annual cells take ``ref_year``; without one from ``year_min`` on, the middle of the last period.

    Stable ones take the middle of their run (``run_start, run_end``, either way round; the whole span of
    years where null) and, if the run has two years or more, for control the middle year within the run
    of the period whose start is farthest from that of the year's own period, the first of two as far.

    Transitions take, over the periods with a dominant class, the start of the first whose class differs
    from the one before, and the middle years of both; without such a change ``ref_year``, or without that
    the middle of the period after the largest jump of the share (the last period if there is none).

    Presence cells take the middle of the period where ``target_class`` dominates most; without one
    ``ref_year`` if in range, or the middle of the period with the largest share.

    Fillers are planned as transitions if their ``transition_pct`` is above the parameter, else as stable
    if ``max_stab_run`` reaches ``stable_run``, else by the middle of the period with most stable years, as
    are cells of any other or no type.  Null measures count as 0; the first of equals wins.
    """
    ps = F.coalesce("periods", F.expr("CAST(array() AS " + dict(cells.dtypes)["periods"] + ")"))
    number = lambda x, default=0.0: F.coalesce(x.cast("double"), F.lit(default))
    ref = F.col("ref_year")
    ref = F.when(ref != NONE, ref)
    last = F.try_element_at(ps, F.lit(-1))["mid"]
    annual = _plan(METHODS[0], (F.coalesce(F.when(ref >= year_min, ref), last), ANNUAL))

    a, b = F.coalesce("run_start", F.lit(year_min)), F.coalesce("run_end", F.lit(year_max))
    start, end = F.least(a, b), F.greatest(a, b)
    year = F.floor((start + end) / 2)
    own = F.try_element_at(F.filter(ps, lambda p: year.between(p["y0"], p["y1"])), F.lit(1))
    inside = F.filter(ps, lambda p: (p["p"] != own["p"]) & p["mid"].between(start, end))
    control = F.when(start < end, _first_most(inside, lambda p: F.abs(p["y0"] - own["y0"])))
    stable = lambda method: _plan(method, (year, ANCHOR), (control, CONTROL))

    known = F.filter(ps, lambda p: ~F.coalesce(p["md_id"], F.lit(0)).isin(0, NONE))
    less = F.greatest(F.size(known) - 1, F.lit(0))
    steps = F.zip_with(F.slice(known, 1, less), F.slice(known, 2, less), lambda x, y: F.struct(x.alias("a"), y.alias("b"), y["mid"].alias("mid")))
    change = F.try_element_at(F.filter(steps, lambda s: s["a"]["md_id"] != s["b"]["md_id"]), F.lit(1))
    jump = F.coalesce(_first_most(steps, lambda s: F.abs(number(s["a"]["md_pct"]) - number(s["b"]["md_pct"]))), last)

    def transition(moved: str, still: str) -> Column:
        whole = _plan(moved, (change["b"]["y0"], DURING), (change["a"]["mid"], BEFORE), (change["b"]["mid"], AFTER))
        return F.when(change.isNotNull(), whole).otherwise(_plan(still, (F.coalesce(ref, jump), DURING)))

    best = _first_most(F.filter(known, lambda p: p["md_id"] == F.col("target_class")), lambda p: number(p["md_pct"]))
    largest = _first_most(ps, lambda p: number(p["md_pct"]))
    in_range = F.when(ref.between(year_min, year_max), ref)
    presence = F.when(best.isNotNull(), _plan(METHODS[4], (best, REPRESENTATIVE))).otherwise(_plan(METHODS[5], (F.coalesce(in_range, largest), REPRESENTATIVE)))

    most_stable = _first_most(ps, lambda p: number(p["n_stable"]))
    filled = METHODS[6]
    filler = F.when(number(F.col("transition_pct")) > transition_pct, transition(filled, filled)).when(number(F.col("max_stab_run")) >= stable_run, stable(filled)).otherwise(_plan(filled, (most_stable, REPRESENTATIVE)))

    kind = F.col("sample_type")
    plan = F.when(kind.isin(*ANNUAL_TYPES), annual).when(kind.isin(*STABLE_TYPES), stable(METHODS[1])).when(kind.isin(*TRANSITION_TYPES), transition(METHODS[2], METHODS[3]))
    plan = plan.when(kind.isin(*PRESENCE_TYPES), presence).when(kind == FILLER_TYPE, filler).otherwise(_plan(METHODS[7], (most_stable, REPRESENTATIVE)))
    out = cells.withColumn("plan", plan).select(*(c for c in cells.columns if c != "periods"), "plan.*")
    return out.withColumn("rev_n_years", sum((F.col(f"rev_year{k}") != NONE).cast("int") for k in (1, 2, 3)))


def long_plan(plan: DataFrame, key: str = "grid_id") -> DataFrame:
    """One row for each cell and slot with a year."""
    slots = F.array(*(F.struct(F.lit(k).alias("slot"), F.col(f"rev_year{k}").alias("year"), F.col(f"rev_role{k}").alias("role")) for k in (1, 2, 3)))
    return plan.select(key, F.explode(slots).alias("s")).select(key, "s.slot", "s.year", "s.role").where(F.col("year") != NONE)


def merged_years(long: DataFrame, key: str = "grid_id") -> DataFrame:
    """One row for each cell and year: the lowest slot's role and all slots."""
    return long.groupBy(key, "year").agg(F.min_by("role", "slot").alias("role"), F.array_join(F.array_sort(F.collect_list("slot")), ",").alias("slots"))


def thin_years(years: Column, k: int) -> Column:
    """At most ``k`` evenly spread entries of a sorted list, its ends among them."""
    n = F.size(years)
    spread = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get(years, F.bround(i * (n - 1) / (k - 1), 0).cast("int")))
    return F.when(n <= k, years).otherwise(F.array_distinct(spread))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence, total: str = "TOTAL") -> DataFrame:
    """Counts of ``row`` by ``col`` with a row and a column of totals."""
    counted = df.groupBy(F.col(row).cast("string").alias(row)).pivot(col, list(values)).count().na.fill(0, [str(v) for v in values])
    summed = counted.withColumn(total, sum((F.col(f"`{v}`") for v in values), F.lit(0)))
    bottom = summed.agg(*(F.sum(f"`{v}`").alias(str(v)) for v in (*values, total))).select(F.lit(total).alias(row), "*")
    return summed.unionByName(bottom)


def latest(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The row of each key with the highest ``order``."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*key, "r.*")


def pending_units(expected: DataFrame, audit: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Units without a complete or empty entry in their latest audit row."""
    done = latest(audit, key, order).where(F.col("status").isin("complete", "empty"))
    return expected.join(done.select(*key), list(key), "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key."""
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new)


def coverage_audit(matrix: DataFrame, candidates: DataFrame, captured: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per zone and class: hectares of the matrix, of candidates and of captured cells, attainable and absolute share, and state."""
    out = matrix.join(candidates.withColumnRenamed("ha", "candidate_ha"), list(key), "left").join(captured.withColumnRenamed("ha", "captured_ha"), list(key), "left")
    out = out.na.fill(0, ["candidate_ha", "captured_ha"])
    reach = F.round(F.coalesce(F.try_divide(100.0 * F.col("captured_ha"), F.col("candidate_ha")), F.lit(0.0)), 4)
    whole = F.round(F.coalesce(F.try_divide(100.0 * F.col("captured_ha"), F.col("ha")), F.lit(0.0)), 4)
    out = out.withColumn("attainable_pct", reach).withColumn("absolute_pct", whole)
    return out.withColumn("state", F.when(F.col("candidate_ha") == 0, "no_candidates").when(F.col("attainable_pct") >= 80, "covered").when(F.col("captured_ha") > 0, "partial").otherwise("missing"))


def compare_runs(runs: DataFrame, base: str, run: str = "run_id") -> DataFrame:
    """Indicators (``run_id, name, value``) of each run beside the base run's: difference and ratio."""
    old = runs.where(F.col(run) == base).select("name", F.col("value").alias("base_value"))
    return runs.where(F.col(run) != base).join(old, "name", "full_outer").withColumn("delta", F.col("value") - F.col("base_value")).withColumn("ratio", F.round(F.try_divide(F.col("value"), F.col("base_value")), 4))
