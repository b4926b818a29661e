"""Acceptance rules over the tables of a run: PASS, FAIL, or NOT-EVALUABLE where a table or column is missing.

A rule says which columns of which tables it needs, what to count in each zone, and how a run's value follows from
the zones.  All rules on one table are evaluated in one pass over it: one aggregate by zone, one over the zones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Classes that no sample may aim at (transversal, masks, no data, unobserved).
TRANSVERSAL = (9, 11, 18, 19, 24, 30, 36, 73, 74, 75, 79, 80)
MASKS = (26, 33, 34, 35)
NO_TARGET = (0, 27)
#: Limits of the rules.
MIN_TRAIN, MIN_CLUSTERS, FILLER_SHARE, SIZE_MIX, PRESENCE_HA, OVERLAP_SHARE = 0.50, 2, 0.15, 0.15, 50.0, 0.001
EPSG = {18: 32718, 19: 32719}
OUTCOMES = ("PASS", "FAIL", "NOT-EVALUABLE")

#: Gives the column of a name that a rule uses for itself.
Named = Callable[[str], Column]

RESULT = "test string, description string, criterion string, value double, result string, detail string"


@dataclass
class Measure:
    """A number from one table: ``zones`` are aggregates of its rows in each zone, ``total`` is one of the zones' rows, from
    the columns that its argument names."""

    table: str
    needs: Sequence[str]
    zones: dict[str, Column]
    total: Callable[[Named], Column]


@dataclass
class Rule:
    """``value`` (the measure ``v``, if none) and ``detail`` follow from the measures by name, ``passes`` from the value.

    A null value (nothing to judge) makes the rule not evaluable.
    """

    test: str
    description: str
    criterion: str
    measures: dict[str, Measure]
    passes: Callable[[Column], Column]
    value: Callable[[Named], Column] = lambda m: m("v")
    detail: Callable[[Named], Column] = lambda m: F.lit("")


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def counting(test: str, description: str, criterion: str, table: str, needs: Sequence[str], condition: Column, passes: Callable[[Column], Column]) -> Rule:
    """A rule on the number of rows that meet a condition."""
    return Rule(test, description, criterion, {"v": Measure(table, needs, {"n": _count(condition)}, lambda z: F.coalesce(F.sum(z("n")), F.lit(0)))}, passes)


def failing_zones(test: str, description: str, criterion: str, table: str, needs: Sequence[str], zones: dict[str, Column], fails: Callable[[Named], Column], said: Callable[[Named], Column]) -> Rule:
    """A rule that no zone may fail; the detail lists those that do, with what is ``said`` of them."""
    listed = lambda z: F.array_join(F.array_sort(F.collect_list(F.when(fails(z), F.concat(F.lit("E"), z("zone").cast("string"), F.lit(":"), said(z))))), "; ")
    return Rule(test, description, criterion, {"v": Measure(table, needs, zones, lambda z: _count(fails(z))), "listed": Measure(table, needs, {}, listed)}, lambda v: v == 0, detail=lambda m: m("listed"))


def within(test: str, description: str, table: str, needs: Sequence[str], condition: Column, low: float, high: float | None = None) -> Rule:
    """A rule of the balance list: so many rows that meet a condition."""
    criterion = f"{low:g} to {high:g}" if high is not None else f"{low:g} or more"
    return counting(test, description, criterion, table, needs, condition, lambda v: (v >= low) & (F.lit(True) if high is None else v <= high))


def selection_rules() -> list[Rule]:
    """The rules on a national selection.

    Tables: ``universe`` (``class_id``), ``selection`` (``zone, target_class, split, cluster, unfeasible, pool, side, mode, ha``),
    ``grid`` (``side``), ``leaks`` (``zone, n``), ``layers`` (``utm, epsg``), ``coverage`` (``mode, share``),
    ``overlap`` (``sum_area, union_area, n_pairs``), ``report`` (``name``).
    """
    split = lambda x: F.col("split") == x
    off = {"off": F.coalesce(F.bool_or("unfeasible"), F.lit(False))}
    clusters = off | {"n_val": F.count_distinct(F.when(split("val"), F.col("cluster"))), "n_test": F.count_distinct(F.when(split("test"), F.col("cluster")))}
    train = {"n_train": _count(split("train")), "n_rows": F.count("*")}
    sides = {"n_3": _count(F.col("side") == 3), "n_23": _count(F.col("side").isin(2, 3))}
    mix = lambda z: F.when(F.sum(z("n_23")) > 0, F.sum(z("n_3")) / F.sum(z("n_23")))
    rare = F.col("mode").isin("census", "reinforcement")
    percent = lambda x: F.concat((F.floor(x * 1000 + 0.5) / 10).cast("string"), F.lit(" %"))
    return [
        counting("1", "Universe of the general model only", "no transversal, mask, empty or unobserved class", "universe", ["class_id"], F.col("class_id").isin(*TRANSVERSAL, *MASKS, *NO_TARGET), lambda v: v == 0),
        counting("2", "No class 0 in the selection", "target_class <> 0", "selection", ["target_class"], F.col("target_class") == 0, lambda v: v == 0),
        *(Rule(f"CRS{utm}", f"Coordinate system of zone {utm}", f"EPSG:{epsg}", {"v": Measure("layers", ["utm", "epsg"], {"e": F.max(F.when(F.col("utm") == utm, F.col("epsg")))}, lambda z: F.max(z("e")))}, lambda v, epsg=epsg: v == epsg) for utm, epsg in EPSG.items()),
        failing_zones("7", "No spatial leak in a zone", "no pairs of neighbours in different splits", "leaks", ["zone", "n"], {"n_leaks": F.sum("n")}, lambda z: z("n_leaks") > 0, lambda z: z("n_leaks").cast("string")),
        failing_zones("8", "Least splits of a zone", "2 clusters or more in val and test, but in unfeasible zones", "selection", ["zone", "split", "cluster", "unfeasible"], clusters, lambda z: ~z("off") & ((z("n_val") < MIN_CLUSTERS) | (z("n_test") < MIN_CLUSTERS)), lambda z: F.concat(F.lit("val="), z("n_val").cast("string"), F.lit(" test="), z("n_test").cast("string"))),
        failing_zones("12", "Least share of train", "half or more of a zone, but in unfeasible zones", "selection", ["zone", "split", "unfeasible"], train | off, lambda z: ~z("off") & (z("n_train") / z("n_rows") < MIN_TRAIN), lambda z: percent(z("n_train") / z("n_rows"))),
        failing_zones("13", "No zone without train", "train in every zone", "selection", ["zone", "split"], train, lambda z: z("n_train") == 0, lambda z: F.lit("0")),
        Rule("15", "Cap of fillers", "fillers are 15 % or less", {"v": Measure("selection", ["pool"], {"n_filler": _count(F.col("pool") == "filler"), "n_rows": F.count("*")}, lambda z: F.round(F.sum(z("n_filler")) / F.sum(z("n_rows")), 4))}, lambda v: v <= FILLER_SHARE + 1e-6),
        Rule("16", "Mix of sizes against the universe", "shares of side 3 within 15 points", {"own": Measure("selection", ["side"], sides, mix), "all": Measure("grid", ["side"], sides, mix)}, lambda v: v <= SIZE_MIX, lambda m: F.round(F.abs(m("own") - m("all")), 4), lambda m: F.concat(F.lit("selection "), percent(m("own")), F.lit(", universe "), percent(m("all")))),
        counting("17", "Least presence in census and reinforcement", "50 ha or more of the class", "selection", ["mode", "ha"], rare & (F.col("ha") < PRESENCE_HA - 1e-6), lambda v: v == 0),
        counting("18", "Coverage of rare classes reported", "a share for every class in census or reinforcement", "coverage", ["mode", "share"], rare & F.col("share").isNull(), lambda v: v == 0),
        counting("A1", "No coverage beyond what can be reached", "shares of 1 or less", "coverage", ["share"], F.col("share") > 1.0001, lambda v: v == 0),
        Rule("21", "Area of the union", "sum and union of areas differ by 0.1 % or less", {"v": Measure("overlap", ["sum_area", "union_area"], {"s": F.sum("sum_area"), "u": F.sum("union_area")}, lambda z: F.round(F.abs(F.sum(z("s")) - F.sum(z("u"))) / F.greatest(F.sum(z("u")), F.lit(1e-9)), 6))}, lambda v: v <= OVERLAP_SHARE),
        Rule("22", "Pairs that overlap", "none", {"v": Measure("overlap", ["n_pairs"], {"p": F.sum("n_pairs")}, lambda z: F.sum(z("p")))}, lambda v: v == 0),
        counting("24", "Report of areas among the outputs", "one or more", "report", ["name"], F.col("name").isNotNull(), lambda v: v >= 1),
    ]


def _lacks(rule: Rule, tables: dict[str, DataFrame]) -> str:
    """The tables and columns that a rule needs and that are not there."""
    found = set()
    for m in rule.measures.values():
        if m.table not in tables:
            found.add(m.table)
        else:
            found |= {f"{m.table}.{c}" for c in m.needs if c not in tables[m.table].columns}
    return ", ".join(sorted(found))


def _one_row(df: DataFrame, measures: list[tuple[str, str, Measure]]) -> DataFrame:
    """All measures on a table as one row, column ``k_name`` for measure ``name`` of rule ``k``."""
    zone = F.col("zone") if "zone" in df.columns else F.lit(None).cast("string")
    inner = [c.alias(f"{k}_{z}") for k, _, m in measures for z, c in m.zones.items()]
    by_zone = df.groupBy(zone.alias("the_zone")).agg(*inner) if inner else df
    return by_zone.agg(*(m.total(lambda z, k=k: F.col("the_zone" if z == "zone" else f"{k}_{z}")).alias(f"{k}_{name}") for k, name, m in measures))


def evaluate(spark: SparkSession, tables: dict[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """A row for each rule: ``test, description, criterion, value, result, detail``.

    A rule is not evaluable if one of its tables isn't there or lacks a column (the detail says which), or if it has
    nothing to judge.  Each table is read once, and gives one row.
    """
    lacks = {f"r{k}": _lacks(rule, tables) for k, rule in enumerate(rules)}
    asked: dict[str, list[tuple[str, str, Measure]]] = {}
    for k, rule in enumerate(rules):
        for name, m in rule.measures.items():
            if not lacks[f"r{k}"]:
                asked.setdefault(m.table, []).append((f"r{k}", name, m))
    whole = spark.range(1)
    for name, measures in asked.items():
        whole = whole.crossJoin(F.broadcast(_one_row(tables[name], measures)))
    rows = []
    for k, rule in enumerate(rules):
        if lacks[f"r{k}"]:
            value, detail = F.lit(None).cast("double"), F.lit(f"missing: {lacks[f'r{k}']}")
        else:
            named = lambda name, k=k: F.col(f"r{k}_{name}")
            value, detail = rule.value(named).cast("double"), rule.detail(named)
        result = F.when(value.isNull(), OUTCOMES[2]).when(rule.passes(value), OUTCOMES[0]).otherwise(OUTCOMES[1])
        rows.append(F.struct(F.lit(rule.test).alias("test"), F.lit(rule.description).alias("description"), F.lit(rule.criterion).alias("criterion"), value.alias("value"), result.alias("result"), F.coalesce(detail, F.lit("")).alias("detail")))
    return whole.select(F.inline(F.array(*rows)))
