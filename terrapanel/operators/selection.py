"""Filters, scores, allocation and ordered selection of sample cells.

The one sequential step, a greedy pick that skips what conflicts with an earlier pick, is done in
rounds over the conflict graph: a candidate is taken once no undecided candidate before it conflicts
with it, and what conflicts with it goes.  The result is what the loop would give.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.sources.shared import discard, partitions, table

#: So few conflicts (24 bytes each) fit one task.
LAST_PAIRS = 200_000
#: So many conflicts are little for one task.
PAIRS_PER_TASK = 500_000


def failure_counts(df: DataFrame, conditions: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows that fail each condition, and that pass all, in one pass; a null counts as failing."""
    ok = {k: F.coalesce(c, F.lit(False)) for k, c in conditions.items()}
    every = F.lit(True)
    for c in ok.values():
        every = every & c
    return df.groupBy(*by).agg(F.count("*").alias("n"), *(F.count(F.when(~c, 1)).alias(f"fails_{k}") for k, c in ok.items()), F.count(F.when(every, 1)).alias("n_pass"))


def funnel(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row for each step: rows that pass it and all steps before."""
    so_far, parts = F.lit(True), []
    for k, c in conditions.items():
        so_far = so_far & F.coalesce(c, F.lit(False))
        parts.append(F.struct(F.lit(len(parts)).alias("step"), F.lit(k).alias("name"), F.count(F.when(so_far, 1)).alias("n")))
    return df.agg(*(p.alias(f"s{i}") for i, p in enumerate(parts))).select(F.explode(F.array(*(F.col(f"s{i}") for i in range(len(parts))))).alias("s")).select("s.*")


def pools(df: DataFrame, members: dict[str, Column]) -> DataFrame:
    """One row for each pool that a cell belongs to."""
    return df.withColumn("pool", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in members.items())))))


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)


def round_robin(df: DataFrame, unit: str, order: Sequence[Column]) -> DataFrame:
    """Ranks that alternate between units: all firsts, then all seconds, best score first."""
    turn = F.row_number().over(Window.partitionBy(unit).orderBy(*order))
    return df.withColumn("turn", turn)


def prefix_until(df: DataFrame, by: Sequence[str], order: Sequence[Column], amount: str, target: Column, n: int) -> DataFrame:
    """Rows in order until the amount of those before reaches the target, ``n`` at most; with the reason of the end."""
    w = Window.partitionBy(*by).orderBy(*order)
    before = F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = df.withColumn("rank", F.row_number().over(w)).withColumn("before", before)
    return ranked.where((F.col("before") < target) & (F.col("rank") <= n))


def coverage_need(df: DataFrame, by: Sequence[str], order: Sequence[Column], amount: str, share: float) -> DataFrame:
    """How many rows in order are needed to reach a share of the group's amount."""
    w = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn("rank", F.row_number().over(w)).withColumn("upto", F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("whole", F.sum(amount).over(Window.partitionBy(*by)))
    return ranked.where(F.col("upto") >= share * F.col("whole")).groupBy(*by).agg(F.min("rank").alias("n_needed"))


def both_directions(conflicts: DataFrame) -> DataFrame:
    """``a, b`` of each conflict in both directions, each once; in as many tasks as the pairs need, dealt out by ``a``."""
    once = table(conflicts.select("a", "b").where("a <> b"), "pairs")
    both = once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.repartition(partitions(once.sparkSession, 2 * once.count(), PAIRS_PER_TASK), "a").distinct()


def in_conflict(pairs: DataFrame, n_pairs: int, ids: DataFrame) -> DataFrame:
    """``id`` of what conflicts with any of ``ids``, each once; ``pairs`` has both directions."""
    n = partitions(pairs.sparkSession, n_pairs, PAIRS_PER_TASK)
    hit = pairs.select("a", "b").repartition(n, "b").join(ids.select(F.col("id").alias("b")).distinct().hint("merge"), "b")
    return hit.select(F.col("a").alias("id")).repartition(n, "id").distinct()


def _greedy(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a greedy pick takes of all conflicts ``a, b, rank_a``, each in both directions."""
    rank, around, kind = {}, {}, None
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b, r in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            rank[a] = r
            around.setdefault(a, []).append(b)
    taken = set()
    for x in sorted(rank, key=rank.__getitem__):
        if taken.isdisjoint(around[x]):
            taken.add(x)
    if taken:
        yield pa.record_batch({"id": pa.array(list(taken), kind)})


def independent_prefix(candidates: DataFrame, conflicts: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """What a greedy pick in the order of ``rank`` takes.

    ``candidates`` has ``id`` and a ``rank`` without ties; ``conflicts`` has pairs ``a, b``, in either or
    both directions; candidates that conflict with an id of ``taken`` are left out first.  Each round's
    state is written to the shared folder; a round decides at least the first undecided candidate of
    every conflict component.  Once no more than ``LAST_PAIRS`` conflicts are left, one task decides them.
    """
    pairs = table(both_directions(conflicts), "conflicts")
    n_pairs = pairs.count()
    left = candidates.select("id", "rank")
    if taken is not None:
        left = left.join(in_conflict(pairs, n_pairs, taken), "id", "left_anti").join(taken.select("id"), "id", "left_anti")
    left = table(left, "undecided")
    own = lambda c: left.select(F.col("id").alias(c), F.col("rank").alias(f"rank_{c}")).hint("merge")
    dealt = lambda rows, c: rows.repartition(partitions(rows.sparkSession, n_pairs, PAIRS_PER_TASK), c)
    old, pairs = pairs, table(dealt(dealt(pairs, "a").join(own("a"), "a"), "b").join(own("b"), "b"), "conflicts")
    discard(old)
    picked = None
    while left.take(1):
        n_pairs = pairs.count()
        if n_pairs <= LAST_PAIRS:
            free = left.join(pairs.select(F.col("a").alias("id")).distinct(), "id", "left_anti").select("id")
            kind = dict(left.dtypes)["id"]
            now = table(free.unionByName(pairs.select("a", "b", "rank_a").coalesce(1).mapInArrow(_greedy, f"id {kind}")), "picked")
            picked = now if picked is None else picked.select("id").unionByName(now)
            discard(left, pairs)
            break
        later = dealt(pairs.where("rank_b < rank_a").select(F.col("a").alias("id")), "id").distinct()
        now = table(left.join(later.hint("merge"), "id", "left_anti"), "picked")
        picked = now if picked is None else picked.unionByName(now)
        gone = in_conflict(pairs, n_pairs, now).unionByName(now.select("id"))
        was, left = left, table(left.join(gone.hint("merge"), "id", "left_anti"), "undecided")
        still = lambda c: left.select(F.col("id").alias(c)).hint("merge")
        old, pairs = pairs, table(dealt(dealt(pairs, "a").join(still("a"), "a", "left_semi"), "b").join(still("b"), "b", "left_semi"), "conflicts")
        discard(was, old)
    return candidates.join(picked.select("id"), "id", "left_semi") if picked is not None else candidates.limit(0)


def budget(zones: DataFrame, total: int, least: int) -> DataFrame:
    """Splits ``total`` over zones by ``score``, none under ``least``; what the floors take is taken from the rest in proportion."""
    whole = Window.partitionBy(F.lit(0))
    share = F.floor(total * F.col("score") / F.sum("score").over(whole))
    out = zones.withColumn("raw", share).withColumn("low", F.col("raw") < least)
    free = total - least * F.sum(F.col("low").cast("int")).over(whole)
    rest = F.sum(F.when(~F.col("low"), F.col("score"))).over(whole)
    return out.withColumn("budget", F.when(F.col("low"), F.lit(least)).otherwise(F.greatest(F.lit(least), F.floor(free * F.col("score") / rest))).cast("long")).drop("raw", "low")


def largest_remainder(df: DataFrame, by: Sequence[str], weight: str, total: int, key: str) -> DataFrame:
    """Whole quotas that add up to ``total`` in each group, by largest remainder; ties go to the smallest key."""
    w = Window.partitionBy(*by)
    exact = F.lit(total) * F.col(weight) / F.sum(weight).over(w)
    out = df.withColumn("exact", exact).withColumn("whole", F.floor("exact"))
    out = out.withColumn("left", F.lit(total) - F.sum("whole").over(w))
    out = out.withColumn("place", F.row_number().over(w.orderBy(F.desc(F.round(F.col("exact") - F.col("whole"), 9)), key)))
    return out.withColumn("quota", (F.col("whole") + (F.col("place") <= F.col("left")).cast("int")).cast("long")).drop("exact", "whole", "left", "place")


def capped_equal(df: DataFrame, by: Sequence[str], available: str, total: int, key: str) -> DataFrame:
    """Equal quotas up to what is available: water filling in closed form, ties to the smallest key.

    In ascending order of what is available, a row gets all it has while that is no more than an equal
    share of what is left; the rest share equally, the first of them one more each.
    """
    w = Window.partitionBy(*by).orderBy(available, key)
    n = F.count("*").over(Window.partitionBy(*by))
    before = F.coalesce(F.sum(available).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = df.withColumn("place", F.row_number().over(w)).withColumn("share", (F.lit(total) - before) / (n - F.col("place") + 1))
    out = out.withColumn("full", F.col(available) <= F.col("share"))
    out = out.withColumn("short", F.max(F.when(F.col("full"), F.col("place"))).over(Window.partitionBy(*by)))
    out = out.withColumn("all", F.col("place") <= F.coalesce("short", F.lit(0)))
    left = F.lit(total) - F.coalesce(F.sum(F.when(F.col("all"), F.col(available))).over(Window.partitionBy(*by)), F.lit(0))
    many = F.count(F.when(~F.col("all"), 1)).over(Window.partitionBy(*by))
    out = out.withColumn("left", left).withColumn("many", many).withColumn("turn", F.col("place") - F.coalesce("short", F.lit(0)))
    equal = F.floor(F.col("left") / F.greatest("many", F.lit(1))) + (F.col("turn") <= F.col("left") % F.greatest("many", F.lit(1))).cast("int")
    return out.withColumn("quota", F.when(F.col("all"), F.col(available)).otherwise(F.greatest(F.lit(0), equal)).cast("long")).drop("place", "share", "full", "short", "all", "left", "many", "turn")


def balanced_years(df: DataFrame, by: Sequence[str], order: Sequence[str], years: Sequence[int], key: str) -> DataFrame:
    """For each row in order the year used least so far in its group; ties by the key's number modulo the ties.

    After as many rows as there are years all are used as often, so the fold starts afresh with each such run of rows.
    """
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order, key))
    df = df.withColumn("run", F.floor((place - 1) / len(years)))
    rows = F.array_sort(F.collect_list(F.struct(*order, key)))
    start = F.create_map(*(x for y in years for x in (F.lit(y), F.lit(0))))
    state = F.struct(start.alias("used"), F.array().cast(f"array<struct<{key}:bigint,ref_year:int>>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        least = F.array_min(F.map_values(acc["used"]))
        ties = F.array_sort(F.map_keys(F.map_filter(acc["used"], lambda k, v: v == least)))
        year = F.element_at(ties, ((row[key] % F.size(ties)) + 1).cast("int"))
        used = F.transform_values(acc["used"], lambda k, v: v + (k == year).cast("int"))
        return F.struct(used.alias("used"), F.concat(acc["out"], F.array(F.struct(row[key].cast("bigint").alias(key), year.alias("ref_year")))).alias("out"))

    return df.groupBy(*by, "run").agg(F.aggregate(rows, state, step)["out"].alias("out")).select(*by, F.inline("out"))


def split_by_cluster(df: DataFrame, by: Sequence[str], cluster: str, order: Column, parts: Sequence[float] = (0.70, 0.15)) -> DataFrame:
    """Train, validation and test by clusters in a fixed shuffled order; tiny groups fill train first, then validation."""
    units = df.select(*by, cluster).distinct()
    w = Window.partitionBy(*by)
    units = units.withColumn("place", F.row_number().over(w.orderBy(order, cluster))).withColumn("n", F.count("*").over(w))
    train = F.greatest(F.lit(1), F.floor(F.col("n") * parts[0] + 0.5))
    val = F.greatest(F.when(F.col("n") >= 2, 1).otherwise(0), F.floor(F.col("n") * parts[1] + 0.5))
    return units.withColumn("split", F.when(F.col("place") <= F.least(train, F.when(F.col("n") >= 3, F.col("n") - 2).when(F.col("n") == 2, F.lit(1)).otherwise(F.col("n"))), "train").when(F.col("place") <= F.least(train, F.when(F.col("n") >= 3, F.col("n") - 2).when(F.col("n") == 2, F.lit(1)).otherwise(F.col("n"))) + val, "val").otherwise("test")).drop("place", "n")


def cap_per_value(df: DataFrame, value: str, exempt: Column, order: Sequence[Column], share: float) -> DataFrame:
    """At most a share of all rows for each value; exempt rows stay and count first."""
    n = df.count()
    most = max(1, int(n * share))
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(value).orderBy(F.desc(exempt), *order))).where(exempt | (F.col("rank") <= most))


def arid_transition(cells: DataFrame, least_transition: float, least_purity: float, arid_zones: Sequence[int]) -> DataFrame:
    """Cells that count as transitions: by transition rate and purity (the greater share of the modal and the last class),
    or in arid zones by a rate lower by two points, three at least, or one of three with two different known classes."""
    rate, purity = F.coalesce("transition_pct", F.lit(0.0)), F.greatest(F.coalesce("mode_pct", F.lit(0.0)), F.coalesce("last_pct", F.lit(0.0)))
    turned = (F.col("mode_id") != F.col("last_id")) & (F.col("mode_id") > 0) & (F.col("last_id") > 0) & (rate >= 3)
    relaxed = F.col("zone").isin(*arid_zones) & ((rate >= max(3.0, least_transition - 2)) | F.coalesce(turned, F.lit(False)))
    return cells.where((rate >= least_transition) & (purity >= least_purity) | F.coalesce(relaxed, F.lit(False)))
