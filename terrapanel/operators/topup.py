"""Passes after the main selection: zones up to their minimum, all up to a total, reserves, rare classes, and repair of labels."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.operators import national
from terrapanel.operators.national import pick_with_quotas
from terrapanel.operators.selection import both_directions, in_conflict
from terrapanel.sources.shared import table

#: Types that fillers get, and the transition rate from which they count as transitions.
TRANSITION, STABLE_YEARS = 8.0, 2
NO_YEAR = -9999
SALTS = 32


def fill_candidates(cells: DataFrame, taken: DataFrame, bare_class: int, bare_zones: Sequence[int], water_class: int) -> DataFrame:
    """Cells that a filling pass may take: not ``taken`` (``id``), no bare ground as modal class in the zones that have much of it
    (unless ``exempt``), and no water as modal class without a rare class."""
    bare = F.col("zone").isin(*bare_zones) & (F.col("class_id") == bare_class) & ~F.coalesce("exempt", F.lit(False))
    water = (F.col("class_id") == water_class) & (F.coalesce(F.trim("rare"), F.lit("")) == "")
    return cells.join(taken.select("id").distinct(), "id", "left_anti").where(~(F.coalesce(bare, F.lit(False)) | F.coalesce(water, F.lit(False))))


def temporal_kind(transition: Column, stable_years: Column) -> Column:
    """``transicion`` from the rate, ``anual`` if a period has stable years enough, else ``estable``."""
    return F.when(F.coalesce(transition, F.lit(0.0)) >= TRANSITION, "transicion").when(F.exists(stable_years, lambda n: n >= STABLE_YEARS), "anual").otherwise("estable")


def fill_type(mixed: Column, homogeneous: bool) -> tuple[Column, Column]:
    """The type and spatial dimension of a filler of column ``kind``; without ``homogeneous`` all are simple."""
    plain = F.lit("simple_media") if not homogeneous else F.when((F.col("kind") == "transicion") | mixed, "simple_media").otherwise("homogenea")
    return F.concat_ws("_", F.col("kind"), plain), plain


def _without_conflicts(rows: DataFrame, conflicts: DataFrame, taken: DataFrame) -> DataFrame:
    return rows.join(in_conflict(conflicts, conflicts.count(), taken), "id", "left_anti")


def _both_ways(conflicts: DataFrame) -> DataFrame:
    return table(both_directions(conflicts), "conflicts")


def _walk(steps: list[tuple[int, int]], budget: int):
    """Cogrouped function: takes of each step (group and quota) in order, as long as the budget lasts."""

    def run(rows: pd.DataFrame, conflicts: pd.DataFrame) -> pd.DataFrame:
        around = defaultdict(list)
        for a, b in zip(conflicts["a"].tolist(), conflicts["b"].tolist(), strict=True):
            around[a].append(b)
        queue = defaultdict(list)
        for step, id_, turn in zip(rows["step"].tolist(), rows["id"].tolist(), zip(*(rows[c].tolist() for c in ("prio", "mixed", "score")), strict=True), strict=True):
            queue[step].append(((*(-x for x in turn), id_), id_))
        taken, out = set(), []
        for step, quota in steps:
            n = 0
            for _, id_ in sorted(queue[step]):
                if n >= quota or len(out) >= budget:
                    break
                if id_ not in taken and taken.isdisjoint(around.get(id_, ())):
                    taken.add(id_)
                    n += 1
                    out.append((step, id_, n))
        return pd.DataFrame(out, columns=["step", "id", "place"])

    return run


def take_in_order(rows: DataFrame, conflicts: DataFrame, steps: list[tuple[int, int]], budget: int) -> DataFrame:
    """``step, id, place`` of what a walk takes: step by step up to its quota, best ``prio``, then ``mixed``, then ``score``, then smallest
    id first, nothing that conflicts with an earlier take, ``budget`` takes in all.  ``conflicts`` has both directions.

    Few candidates and conflicts (counted first) are walked through by one task; else each step is picked in rounds.
    """
    rows = table(rows.select(F.col("step").cast("int").alias("step"), F.col("id").cast("long").alias("id"), F.col("prio").cast("double").alias("prio"), F.col("mixed").cast("double").alias("mixed"), F.col("score").cast("double").alias("score")), "rows")
    if rows.count() <= national.LAST_CANDIDATES and conflicts.count() <= national.LAST_PAIRS:
        run = _walk(steps, budget)
        one = F.lit(1).alias("all")
        return rows.select("*", one).groupBy("all").cogroup(conflicts.select("a", "b", one).groupBy("all")).applyInPandas(lambda a, b: run(a, b), "step int, id long, place int")
    out, left = None, budget
    for step, quota in steps:
        if min(quota, left) <= 0:
            continue
        mine = rows.where(F.col("step") == step)
        if out is not None:
            mine = _without_conflicts(mine, conflicts, out).join(out.select("id"), "id", "left_anti")
        turn = F.struct(-F.col("prio"), -F.col("mixed"), -F.col("score"), F.col("id"))
        now = pick_with_quotas(mine.select(F.lit("step").alias("pool"), "id", turn.alias("turn")), conflicts, [("step", min(quota, left))])
        now = table(now.select(F.lit(step).alias("step"), "id", F.row_number().over(Window.partitionBy("pool").orderBy("turn")).alias("place")), "takes")
        left -= now.count()
        out = now if out is None else out.unionByName(now)
    return out if out is not None else rows.select("step", "id", F.lit(1).alias("place")).limit(0)


def fill_zone_minimum(selected: DataFrame, candidates: DataFrame, conflicts: DataFrame, least: int, priority: Sequence[int], max_add: int, bare_class: int) -> DataFrame:
    """``id, zone, place, sample_type, dim_temporal, dim_espacial`` of the cells that lift zones to ``least`` cells each.

    Zones of ``priority`` come first, then those with fewest cells, then the smallest; ``max_add`` cells in all.  A zone takes cells of a
    kind in time that its selection lacks first, then of a modal class that it lacks, bare ground last, then
    mixed cells, then the best score.  ``selected`` has ``id, zone, class_id, dim_temporal``; ``candidates`` (see :func:`fill_candidates`) ``id, zone,
    class_id, transition_pct``, ``stable_years`` (of each period), ``mixed`` and ``score``.
    """
    both = _both_ways(conflicts)
    have = dict(selected.groupBy("zone").agg(F.count("*").alias("n")).collect())
    zones = {r[0] for r in candidates.select("zone").distinct().collect()} | set(priority)
    order = sorted(zones, key=lambda z: (z not in priority, have.get(z, 0), z))
    steps = [(k, least - have.get(z, 0)) for k, z in enumerate(order)]
    number = F.create_map(*(x for k, z in enumerate(order) for x in (F.lit(z), F.lit(k))))[F.col("zone")]
    free = _without_conflicts(candidates.withColumn("kind", temporal_kind(F.col("transition_pct"), F.col("stable_years"))), both, selected)
    kinds = selected.select("zone", F.col("dim_temporal").alias("kind"), F.lit(0).alias("new_kind")).distinct()
    classes = selected.select("zone", "class_id", F.lit(0).alias("new_class")).distinct()
    lacks = free.join(F.broadcast(kinds), ["zone", "kind"], "left").join(F.broadcast(classes), ["zone", "class_id"], "left")
    prio = 2 * F.coalesce("new_kind", F.lit(1)) + F.coalesce("new_class", F.lit(1)) - F.coalesce((F.col("class_id") == bare_class).cast("int"), F.lit(0))
    rows = table(lacks.withColumn("prio", prio).withColumn("step", number), "fill")
    taken = take_in_order(rows, both, [s for s in steps if s[1] > 0], max_add)
    kind, plain = fill_type(F.col("mixed"), False)
    return taken.join(rows.select("id", "zone", "kind", "mixed"), "id").select("id", "zone", "place", kind.alias("sample_type"), F.col("kind").alias("dim_temporal"), plain.alias("dim_espacial"))


def fill_to_total(selected: DataFrame, candidates: DataFrame, conflicts: DataFrame, target: int) -> DataFrame:
    """``id, zone, place, sample_type, dim_temporal, dim_espacial`` of the cells that bring the selection to ``target``, mixed ones first, then
    by score."""
    both = _both_ways(conflicts)
    need = max(0, target - selected.count())
    free = _without_conflicts(candidates.withColumn("kind", temporal_kind(F.col("transition_pct"), F.col("stable_years"))), both, selected)
    rows = table(free.withColumn("prio", F.lit(0)).withColumn("step", F.lit(0)), "fill")
    taken = take_in_order(rows, both, [(0, need)], need)
    kind, plain = fill_type(F.col("mixed"), True)
    return taken.join(rows.select("id", "zone", "kind", "mixed"), "id").select("id", "zone", "place", kind.alias("sample_type"), F.col("kind").alias("dim_temporal"), plain.alias("dim_espacial"))


def first_of_groups(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group with their ``place``; groups are ranked in salted parts first, so a large one is no task of its own."""
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    near = df.withColumn("place", F.row_number().over(Window.partitionBy(group, salt).orderBy(*order))).where(F.col("place") <= n)
    return near.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= n)


def reserves(selected: DataFrame, candidates: DataFrame, fragile: Sequence[int], n: int, enough: int = 6) -> DataFrame:
    """``id, zone, place``: ``n`` candidates in reserve for each fragile zone that has no more than ``enough`` cells."""
    many = selected.groupBy("zone").agg(F.count("*").alias("n_zone")).where(F.col("n_zone") > enough).select("zone")
    free = candidates.where(F.col("zone").isin(*fragile)).join(F.broadcast(many), "zone", "left_anti").join(selected.select("id"), "id", "left_anti")
    return first_of_groups(free, "zone", [F.desc("mixed"), F.desc("score"), F.asc("id")], n).select("id", "zone", "place")


@dataclass(frozen=True)
class Limits:
    """From where cells count as stable, annual or in transition."""

    run_homogeneous: float
    run_simple: float
    share_homogeneous: float
    share_simple: tuple[float, float]
    change_homogeneous: float
    change_simple: float
    diversity: float
    classes_simple: tuple[int, int]
    stable_share: float
    years_homogeneous: int
    years_simple: int
    change: float
    classes_change: int
    share_change: float


def rare_type(limits: Limits) -> Column:
    """The type of a cell picked for a rare class: by its changes, its best period's stable years, else as stable."""
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    latest = F.try_element_at(F.reverse(F.filter("stable_years", lambda x: x >= 1)), F.lit(1))
    moved = F.when((n("n_classes") >= limits.classes_change) & (n("mode_pct") < limits.share_change), "transicion_simple_media").otherwise("transicion_homogenea")
    steady = ~F.col("mixed") & (n("max_run") >= limits.run_homogeneous) & (n("mode_pct") >= limits.share_homogeneous) & (n("diversity") <= limits.diversity)
    return F.when(n("transition_pct") >= limits.change, moved).when(~F.col("mixed") & (latest >= limits.years_homogeneous), "anual_homogenea").when(latest >= limits.years_simple, "anual_simple_media").when(steady, "estable_homogenea").otherwise("estable_simple_media")


def rare_class_pick(cells: DataFrame, order: Sequence[Column], per_zone: int, most: int, limits: Limits) -> DataFrame:
    """``cells`` of a rare class (``id, zone`` and measures) that are picked, with ``sample_type`` and ``topped_up``.

    In order, ``per_zone`` of each zone, ``most`` in all; where that gives fewer, the best of the rest top it up.
    """
    firsts = first_of_groups(cells, "zone", order, per_zone).orderBy(*order).limit(most).select("id")
    chosen = table(firsts.withColumn("topped_up", F.lit(False)), "rare")
    lacks = most - chosen.count()
    if lacks > 0:
        rest = cells.join(chosen.select("id"), "id", "left_anti").orderBy(*order).limit(lacks).select("id", F.lit(True).alias("topped_up"))
        chosen = chosen.unionByName(rest)
    return cells.join(F.broadcast(chosen), "id").withColumn("sample_type", rare_type(limits))


def promoted(limits: Limits) -> Column:
    """What an annual cell without a reference year is promoted to: ``estable_homogenea``, ``estable_simple_media`` or null."""
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    pure = ~F.col("mixed") & (n("max_run") >= limits.run_homogeneous) & (n("mode_pct") >= limits.share_homogeneous) & (n("transition_pct") <= limits.change_homogeneous) & (n("diversity") <= limits.diversity)
    low, high = limits.share_simple
    simple = (n("max_run") >= limits.run_simple) & (n("mode_pct") >= low) & (n("mode_pct") < high) & n("n_classes").between(*limits.classes_simple) & (n("transition_pct") <= limits.change_simple)
    return F.when(pure, "estable_homogenea").when(simple, "estable_simple_media")


def _balanced(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reference years of annual cells in order; the state is how often each year is used so far."""
    used: dict[int, int] = {}
    for batch in batches:
        out = []
        for id_, least, periods in zip(batch["id"].tolist(), batch["least"].tolist(), batch["years"].tolist(), strict=True):
            year = NO_YEAR
            for k in range(least, 0, -1):
                years = sorted(int(y) for p in periods if len(p) >= k for y in p)
                if years:
                    few = min(used.get(y, 0) for y in years)
                    ties = [y for y in years if used.get(y, 0) == few]
                    year = ties[sum(map(ord, str(id_))) % len(ties)] if used else max(years)
                    used[year] = used.get(year, 0) + 1
                    break
            out.append((id_, year))
        yield pd.DataFrame(out, columns=["id", "ref_year"])


def repair_labels(samples: DataFrame, order: Sequence[Column], limits: Limits) -> DataFrame:
    """``samples`` with ``sample_type``, ``dim_temporal``, ``dim_espacial`` and ``ref_year`` set right.

    Homogeneous annual samples that are stable enough become stable.  The other annual ones take, in order, the stable year used least so
    far from periods with enough stable years, at thresholds that fall by one until some period has them (of equals by the id's
    letters; the very first takes its last year).  Those without any are promoted to stable where they can be, else they
    go.  ``years`` has an array of stable years for each period.

    The balance is a fold over the annual samples of a finished selection, whose state is a count for each year: one
    task reads them in order and holds no more than that.
    """
    n = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    early = (F.col("sample_type") == "anual_homogenea") & (n("max_run") >= limits.run_homogeneous) & (n("mode_pct") >= limits.share_homogeneous) & (n("transition_pct") <= limits.change_homogeneous) & (n("stable_pct") >= limits.stable_share)
    early = F.coalesce(early, F.lit(False))
    rows = table(samples.withColumn("early", early), "samples")
    annual = rows.where(~F.col("early") & (F.col("dim_temporal") == "anual")).withColumn("least", F.when(F.col("dim_espacial") == "homogenea", limits.years_homogeneous).otherwise(limits.years_simple))
    years = table(annual.orderBy(*order).select(F.col("id").cast("string").alias("id"), "least", "years").coalesce(1).mapInPandas(_balanced, "id string, ref_year int"), "years")
    found = rows.join(years.select(F.col("id").alias("key"), F.col("ref_year").alias("found")), F.col("id").cast("string") == F.col("key"), "left").drop("key")
    lost = F.col("found") == NO_YEAR
    up = F.when(F.col("early"), F.lit("estable_homogenea")).when(lost, promoted(limits))
    out = found.withColumn("up", up).where(~F.coalesce(lost & F.col("up").isNull(), F.lit(False)))
    parts = {"sample_type": F.coalesce("up", "sample_type"), "dim_temporal": F.when(F.col("up").isNotNull(), "estable").otherwise(F.col("dim_temporal")), "dim_espacial": F.when(F.col("up") == "estable_homogenea", "homogenea").when(F.col("up").isNotNull(), "simple_media").otherwise(F.col("dim_espacial"))}
    year = F.when(F.col("up").isNotNull(), NO_YEAR).otherwise(F.coalesce("found", *(["ref_year"] if "ref_year" in samples.columns else []), F.lit(NO_YEAR)))
    return out.withColumns(parts | {"ref_year": year.cast("int")}).drop("up", "found", "early")


def stratified_split(samples: DataFrame, stratum: Sequence[str], unit: str, order: Column, parts: tuple[float, float] = (0.15, 0.15)) -> DataFrame:
    """``stratum, unit, split``: shares for validation and test (halves to even, one unit each at least) of each stratum's units in
    order, train first; a single unit trains, of two the second validates."""
    units = samples.select(*stratum, unit).distinct()
    w = Window.partitionBy(*stratum)
    placed = units.withColumn("_place", F.row_number().over(w.orderBy(order, unit))).withColumn("_n", F.count("*").over(w))
    share = lambda p: F.greatest(F.lit(1), F.bround(F.col("_n") * p, 0).cast("int"))
    val = F.when(F.col("_n") == 1, 0).when(F.col("_n") == 2, 1).otherwise(share(parts[0]))
    test = F.when(F.col("_n") <= 2, 0).otherwise(share(parts[1]))
    train = F.greatest(F.lit(1), F.col("_n") - val - test)
    return placed.withColumn("split", F.when(F.col("_place") <= train, "train").when(F.col("_place") <= train + val, "val").otherwise("test")).drop("_place", "_n")
