"""Review plans of the earlier generation: a set of years for each cell, and the national plan put together from zone plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapanel.operators.reviewplan import NONE, thin_years

#: What the plans call their rules and notes.
RULES = ("anual_ref_year", "anual_fallback_stable_year", "estable_anclas_temporales", "transicion_cambio_modal_entre_periodos", "transicion_anios_no_estables", "transicion_sin_anio_exacto_usar_anclas", "fallback_anclas_temporales")
NOTES = ("anual_sin_ref_year_valido", "dim_temporal_no_reconocida", "incluye_anios_clase_rara")
#: The usual periods, and the types that are looked at first.
PERIODS = (("P1", 1999, 2005), ("P2", 2006, 2012), ("P3", 2013, 2018), ("P4", 2019, 2024))
FIRST_TYPES = ("transicion_homogenea", "anual_homogenea")


def _text(c: Column) -> Column:
    """Text without blanks around it; nulls and what tables write for them are empty."""
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(F.lower(t).isin("nan", "none"), "").otherwise(t)


def _whole(c: Column, default: int = NONE) -> Column:
    return F.coalesce(c.try_cast("double").cast("int"), F.lit(default))


def _years(*values: int) -> Column:
    return F.array(*map(F.lit, values))


def _nearest(target: int, years: Column) -> Column:
    """The year nearest to ``target``, the earlier of two as near."""
    return F.array_min(F.transform(years, lambda y: F.struct(F.abs(y - target).alias("far"), y.alias("year"))))["year"]


class _Planner:
    """Sets of years as Columns, for one list of periods."""

    def __init__(self, periods: Sequence[tuple[str, int, int]], most: tuple[int, int, int], columns: Sequence[str]):
        self.periods, self.most, self.columns = periods, most, columns
        self.first, self.last = periods[0][1], periods[-1][2]
        self.stable = F.col("_stable")

    def column(self, name: str) -> Column:
        return F.col(name) if name in self.columns else F.lit(None).cast("string")

    def parsed(self, name: str) -> Column:
        """The years of a comma-separated list that are whole numbers in range, each once, in order."""
        parts = F.transform(F.split(F.coalesce(self.column(name).cast("string"), F.lit("")), ","), lambda x: F.trim(x))
        return self.compact(F.transform(F.filter(parts, lambda p: p.rlike("^[0-9]+$")), lambda p: p.try_cast("int")))

    def compact(self, years: Column, most: int | None = None) -> Column:
        """In order, each once, those in range; with ``most``, so many of them, evenly spread."""
        kept = F.array_sort(F.array_distinct(F.filter(years, lambda y: y.between(self.first, self.last))))
        if most is None:
            return kept
        return F.slice(kept, 1, most) if most <= 2 else thin_years(kept, most)

    def boundaries(self) -> Column:
        """Four years around each border between periods whose classes differ."""
        parts = []
        for (a, _, _), (b, start, _) in zip(self.periods[:-1], self.periods[1:], strict=True):
            differs = _whole(self.column(f"md_id_{a}")) != _whole(self.column(f"md_id_{b}"))
            parts.append(F.when(differs, _years(*range(start - 2, start + 2))).otherwise(F.array().cast("array<int>")))
        return self.compact(F.concat(*parts), self.most[0])

    def unstable(self) -> Column:
        """Each year that isn't stable with the years before and after; none where no stable years are known."""
        others = F.array_except(F.sequence(F.lit(self.first), F.lit(self.last)), self.stable)
        around = F.flatten(F.transform(others, lambda y: F.array(y - 1, y, y + 1)))
        return F.when(F.size(self.stable) > 0, self.compact(around, self.most[0])).otherwise(F.array().cast("array<int>"))

    def rare(self) -> Column:
        """The first and last stable year of each period where the rare class dominates, or the period's ends."""
        name, number, parts = _text(self.column("target_rare_class")), _whole(self.column("target_rare_class_id")), []
        for p, start, end in self.periods:
            own = ((number > 0) & (_whole(self.column(f"md_id_{p}")) == number)) | ((name != "") & (_text(self.column(f"md_nm_{p}")) == name))
            stable = F.col(f"_stable_{p}")
            ends = F.when(F.size(stable) > 0, F.array(F.array_min(stable), F.array_max(stable))).otherwise(_years(start, end))
            parts.append(F.when(own, ends).otherwise(F.array().cast("array<int>")))
        return self.compact(F.concat(*parts), self.most[1])

    def anchors(self) -> Column:
        """The first year, the start of the third period and the last year, or the stable years nearest to them."""
        middle = self.periods[min(2, len(self.periods) - 1)][1]
        has = lambda y: F.array_contains(self.stable, F.lit(y))
        chosen = F.array(F.when(has(self.first), self.first).otherwise(_nearest(self.first + 2, self.stable)), F.when(has(middle), middle).otherwise(_nearest(middle, self.stable)), F.array_max(self.stable))
        return F.when(F.size(self.stable) > 0, self.compact(F.array_compact(chosen))).otherwise(_years(self.first, middle, self.last))


def earlier_plan(cells: DataFrame, periods: Sequence[tuple[str, int, int]] = PERIODS, most: tuple[int, int, int] = (9, 6, 10)) -> DataFrame:
    """``cells`` with ``review_years, n_review_years, review_rule, review_priority, review_notes``.

    By ``dim_temporal``: annual cells take ``ref_year``, or without a valid one the stable year nearest to the last period's start;
    stable ones three anchors; transitions the years around borders of periods whose modal classes (``md_id_*``) differ, else around the years
    that are not stable, else the first year and the ends of all periods.  Others take the anchors.  Years of periods where
    the rare class (``target_rare_class`` or its id) dominates come on top.  ``most`` bounds windows, rare years and all
    years; longer sets are thinned evenly, ends kept.  Priority is ``review_tier`` (2 where unknown), 1 at most for rare classes,
    transitions and homogeneous types.  Columns that a table lacks count as null.
    """
    p = _Planner(periods, most, cells.columns)
    # Each set of years is a column of its own, so that none is worked out more than once.
    cells = cells.withColumn("_stable", p.parsed("stable_years")).withColumns({f"_stable_{name}": p.parsed(f"stb_yrs_{name}") for name, _, _ in periods})
    cells = cells.withColumns({"_windows": p.boundaries(), "_around": p.unstable(), "_rare": p.rare(), "_anchors": p.anchors(), "_late": _nearest(periods[-1][1], p.stable)})
    dim, ref = _text(p.column("dim_temporal")), _whole(p.column("ref_year"))
    has_ref = ref.between(p.first, p.last)
    late, windows, around = F.col("_late"), F.col("_windows"), F.col("_around")
    none = F.array().cast("array<int>")
    ends = _years(p.first, *(y for _, _, y in periods))
    annual, stable, moved = dim == "anual", dim == "estable", dim == "transicion"
    by_border, by_year = F.size(windows) > 0, F.size(around) > 0
    years = F.when(annual & has_ref, F.array(ref)).when(annual & late.isNotNull(), F.array(late)).when(annual, none).when(~moved, F.col("_anchors")).when(by_border, windows).when(by_year, around).otherwise(ends)
    rule = F.when(annual & ~has_ref & late.isNotNull(), RULES[1]).when(annual, RULES[0]).when(stable, RULES[2]).when(~moved, RULES[6]).when(by_border, RULES[3]).when(by_year, RULES[4]).otherwise(RULES[5])
    notes = [F.when(annual & ~has_ref, NOTES[0]), F.when(~(annual | stable | moved), NOTES[1])]
    out = cells.withColumn("_base", p.compact(years))
    whole = F.when(F.size("_rare") > 0, p.compact(F.concat("_base", "_rare"), most[2])).otherwise(F.col("_base"))
    out = out.withColumn("_all", whole)
    first = (_text(p.column("target_rare_class")) != "") | moved | _text(p.column("sample_type")).isin(*FIRST_TYPES)
    tier = _whole(p.column("review_tier"), 2)
    more = F.when(F.size(F.array_except("_all", "_base")) + F.size(F.array_except("_base", "_all")) > 0, NOTES[2])
    out = out.withColumns({"review_years": F.array_join("_all", ","), "n_review_years": F.size("_all"), "review_rule": rule, "review_priority": F.when(first, F.least(tier, F.lit(1))).otherwise(tier), "review_notes": F.concat_ws(";", *notes, more)})
    return out.drop("_base", "_rare", "_all", "_stable", "_windows", "_around", "_anchors", "_late", *(f"_stable_{name}" for name, _, _ in periods))


#: What columns of a national plan hold where a zone plan has none.
TEXT_DEFAULTS = {
    "utm": "UTM", "grid_id": "", "review_years": "", "review_rule": "sin_regla", "review_notes": "", "sample_type": "sin_tipo", "dim_temporal": "sin_dim_temporal", "dim_espacial": "sin_dim_espacial",
    "split": "sin_split", "target_rare_class": "", "review_desc": "", "review_status": "", "ref_period": "", "ref_sensor": "", "lulc_mode_name": "", "eco_dom_name": "", "fuente_plan": "",
}
NUMBER_DEFAULTS = {"review_priority": 3, "review_tier": 3, "ref_year": NONE, "lulc_mode_id": NONE, "eco_dom_id": NONE, "transition_pct": 0.0, "max_stab_run": 0.0}
ORDER = ("review_priority", "utm", "dim_temporal", "sample_type", "review_rule", "grid_id")
#: Fixed value: cells that need no review are described so.
AUTOMATIC = "auto_sin_revision"


def national_plan(plans: dict[str, DataFrame]) -> DataFrame:
    """Zone plans, by the name of their source, as one table with defaults, flags, and years as ``review_years_list``.

    A plan without ``utm`` takes it from its source's name (``UTM18`` or ``UTM19`` in it, else the default).
    Missing columns and nulls take the defaults; numbers that can't be read too.
    """
    whole = None
    for source, plan in plans.items():
        zone = next((z for z in ("UTM18", "UTM19") if z in source.upper()), TEXT_DEFAULTS["utm"])
        own = plan.withColumn("utm", F.coalesce(F.col("utm").cast("string"), F.lit(zone)) if "utm" in plan.columns else F.lit(zone)).withColumn("fuente_plan", F.lit(source))
        own = own.select(*(F.col(c).cast("string").alias(c) for c in own.columns))
        whole = own if whole is None else whole.unionByName(own, allowMissingColumns=True)
    there = lambda c: F.col(c) if c in whole.columns else F.lit(None).cast("string")
    text = {c: F.coalesce(there(c), F.lit(d)) for c, d in TEXT_DEFAULTS.items()}
    number = {c: F.coalesce(there(c).try_cast("double"), F.lit(float(d))).cast("int" if isinstance(d, int) else "double") for c, d in NUMBER_DEFAULTS.items()}
    out = whole.withColumns(text | number)
    parts = F.filter(F.transform(F.split("review_years", ","), lambda p: F.trim(p).try_cast("double").cast("int")), lambda y: y.isNotNull())
    out = out.withColumn("review_years_list", F.array_sort(F.array_distinct(parts)))
    flags = {"n_review_years": F.size("review_years_list"), "has_review_years": F.size("review_years_list") > 0, "is_auto_sin_revision": F.col("review_desc") == AUTOMATIC, "has_rare_class": F.trim("target_rare_class") != ""}
    return out.withColumns({"review_years": F.array_join("review_years_list", ",")} | flags)


def ordered(plan: DataFrame, by: Sequence[str] = ORDER) -> DataFrame:
    """The plan in its working order, sorted in ranges by all machines."""
    return plan.orderBy(*by)


def plan_by_year(plan: DataFrame) -> DataFrame:
    """One row for each cell and review year, with what reviewers need to know of the cell."""
    keep = ["utm", "grid_id", "sample_type", "dim_temporal", "dim_espacial", "review_rule", "review_priority", "review_tier", "review_desc", "review_status", "split", "target_rare_class", "lulc_mode_id", "lulc_mode_name", "eco_dom_id", "eco_dom_name", "ref_year", "ref_period", "ref_sensor", "fuente_plan"]
    return plan.select(F.explode("review_years_list").alias("year"), *keep)


def manual_list(plan: DataFrame) -> DataFrame:
    """Every cell for the manual review, also those of priority 0 or without need of review."""
    keep = ["utm", "grid_id", "sample_type", "dim_temporal", "dim_espacial", "review_years", "n_review_years", "review_rule", "review_priority", "review_notes", "review_tier", "review_desc", "review_status", "split", "lulc_mode_id", "lulc_mode_name", "eco_dom_id", "eco_dom_name", "target_rare_class", "transition_pct", "stable_years", "max_stab_run", "ref_year", "ref_period", "ref_sensor", "fuente_plan"]
    return plan.select(*(c for c in keep if c in plan.columns))


def plan_summary(plan: DataFrame) -> DataFrame:
    """Cells, cells with years, years, rare cells and automatic ones of each zone plan."""
    figures = [F.count("*").alias("n"), F.count(F.when(F.col("has_review_years"), 1)).alias("n_with_years"), F.sum("n_review_years").alias("n_years"), F.count(F.when(F.col("has_rare_class"), 1)).alias("n_rare"), F.count(F.when(F.col("is_auto_sin_revision"), 1)).alias("n_auto")]
    return plan.groupBy("utm").agg(*figures)
