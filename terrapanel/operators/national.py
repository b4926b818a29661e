"""The selection over all zones: pools in order, then a filler, against one set of cells that are taken.

Zones come one after the other, smallest first; in a zone its pools come in order, each with a quota; what a
zone still lacks the filler takes, as far as the national cap leaves room.  A cell is picked unless it is taken, or
conflicts with a pick; once a pool's quota is full the rest of it blocks nobody.  Every candidate gets a decision.

Where candidates and conflicts are few (counted first) one task walks through them.  Beyond that each zone is picked in rounds:
a candidate is taken once it is certain to be within its pool's quota and no undecided candidate before it conflicts with
it.  Both ways give what the loop gives.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.operators.selection import both_directions
from terrapanel.sources.shared import discard, table

#: So many candidates and conflicts fit one task.
LAST_CANDIDATES, LAST_PAIRS = 500_000, 400_000
FILLER = "filler"
#: The filler looks at large cells first.
FILLER_SIDES = (3, 2)
SALTS = 32

LOG = "zone long, pool string, id long, decision string, by long, place int"


@dataclass
class Zone:
    """A zone's pools in order with their quotas, the most cells it may have, and what its classes should reach."""

    zone: int
    quotas: list[tuple[str, int]]
    most: int
    wanted: dict[int, float] = field(default_factory=dict)


def class_state(got: float, wanted: float) -> int:
    """0: nothing of a wanted class is picked, 1: less than wanted, 2: enough, or not wanted."""
    return 2 if wanted <= 0 or got >= wanted else int(got > 0)


def filler_quota(zone: Zone, n_zone: int, n_all: int, n_filled: int, share: float) -> tuple[int, bool]:
    """How many cells the filler may take, and whether the national cap is what limits it.

    ``n_zone`` and ``n_all`` count picks of pools in this zone and in all so far, ``n_filled`` the fillers so far; fillers may
    make up ``share`` of all picks.
    """
    lacks, left = max(0, zone.most - n_zone), max(0, int(share / (1 - share) * n_all + 1e-9) - n_filled)
    return min(lacks, left), left < lacks


class _Walk:
    """The loop in one task; ``around`` has the conflicts of each id."""

    def __init__(self, around: dict[int, list[int]], taken: dict[int, int]):
        self.around, self.taken, self.log = around, dict(taken), []

    def pool(self, zone: int, pool: str, rows: list[tuple], quota: int, full: str = "quota_full") -> list[tuple]:
        """Picks from ``rows`` of ``(id, passes, ...)`` in order."""
        picks = []
        for row in rows:
            what, by = self._judge(row, len(picks) >= quota, full)
            if what == "picked":
                picks.append(row)
                self.taken[row[0]] = len(self.taken)
            self.log.append((zone, pool, row[0], what, by, len(picks) if what == "picked" else None))
        return picks

    def _judge(self, row: tuple, is_full: bool, full: str) -> tuple[str, int | None]:
        if not row[1]:
            return "filtered", None
        if is_full:
            return full, None
        if row[0] in self.taken:
            return "picked_before", row[0]
        hits = [x for x in self.around.get(row[0], ()) if x in self.taken]
        return ("blocked", min(hits, key=self.taken.__getitem__)) if hits else ("picked", None)


def _in_one_task(zones: list[Zone], share: float):
    """Cogrouped function: all candidates and all conflicts give the whole log."""

    def run(candidates: pd.DataFrame, conflicts: pd.DataFrame) -> pd.DataFrame:
        around = defaultdict(list)
        for a, b in zip(conflicts["a"].tolist(), conflicts["b"].tolist(), strict=True):
            around[a].append(b)
        rows = defaultdict(list)
        for zone, pool, id_, passes, class_id, amount, side, rank in zip(*(candidates[c].tolist() for c in ("zone", "pool", "id", "passes", "class_id", "amount", "side", "rank")), strict=True):
            rows[zone, pool].append((id_, passes, class_id, amount, side, rank))
        walk, n_all, n_filled = _Walk(around, {}), 0, 0
        for z in zones:
            got, n_zone = defaultdict(float), 0
            for pool, quota in z.quotas:
                for pick in walk.pool(z.zone, pool, sorted(rows[z.zone, pool], key=lambda r: r[5]), quota):
                    got[pick[2]] += pick[3]
                    n_zone += 1
            n_all += n_zone
            room, capped = filler_quota(z, n_zone, n_all, n_filled, share)
            order = sorted(rows[z.zone, FILLER], key=lambda r: (FILLER_SIDES.index(r[4]) if r[4] in FILLER_SIDES else len(FILLER_SIDES), class_state(got[r[2]], z.wanted.get(r[2], 0)), r[5]))
            n_filled += len(walk.pool(z.zone, FILLER, order, room, "national_cap" if capped else "quota_full"))
        return pd.DataFrame(walk.log, columns=["zone", "pool", "id", "decision", "by", "place"]).astype({"by": "Int64", "place": "Int32"})

    return run


def _first_of_pools(undecided: DataFrame, room: dict[str, int]) -> DataFrame:
    """Of each pool the first undecided candidates that its quota surely has room for; a pool is ranked in salted parts first."""
    left = F.create_map(*(x for p, n in room.items() for x in (F.lit(p), F.lit(n))))[F.col("pool")]
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    near = undecided.withColumn("k", F.row_number().over(Window.partitionBy("pool", salt).orderBy("turn"))).where(F.col("k") <= left)
    return near.withColumn("k", F.row_number().over(Window.partitionBy("pool").orderBy("turn"))).where(F.col("k") <= left).drop("k")


def _walk_left(level: dict[str, int], room: dict[str, int]):
    """Cogrouped function: what is taken of the undecided candidates in order, given what they wait for."""

    def run(undecided: pd.DataFrame, waits: pd.DataFrame) -> pd.DataFrame:
        before = defaultdict(list)
        for pool, id_, *other in zip(*(waits[c].tolist() for c in ("pool_a", "a", "pool_b", "b")), strict=True):
            before[pool, id_].append(tuple(other))
        left, taken = dict(room), {}
        for _, _, pool, id_ in sorted((level[p], k, p, i) for p, k, i in zip(*(undecided[c].tolist() for c in ("pool", "k", "id")), strict=True)):
            if left[pool] > 0 and taken.keys().isdisjoint(before.get((pool, id_), ())):
                taken[pool, id_] = True
                left[pool] -= 1
        return pd.DataFrame(list(taken), columns=["pool", "id"]).astype({"pool": object, "id": "int64"})

    return run


def pick_with_quotas(candidates: DataFrame, conflicts: DataFrame, quotas: list[tuple[str, int]]) -> DataFrame:
    """``pool, id, turn`` of what a walk through the pools takes, in rounds.

    ``candidates`` has ``pool, id, turn`` (``turn`` orders a pool and has no ties there), ``conflicts`` pairs ``a, b`` in
    both directions; cells that conflict with earlier picks are no longer among the candidates.  A candidate is surely within its
    quota if the picks of its pool so far and the undecided ones before it are fewer than the quota; the first
    undecided candidate of all always is, so every round decides at least one.  Once few candidates and waits are left (counted
    first) one task decides them.
    """
    number = {p: k for k, (p, _) in enumerate(quotas)}
    level = F.create_map(*(x for p, k in number.items() for x in (F.lit(p), F.lit(k))))
    undecided = table(candidates.where(F.col("pool").isin(*number)).select("pool", "id", "turn"), "undecided")
    one = undecided.select(F.col("pool").alias("pool_a"), F.col("id").alias("a"), F.col("turn").alias("turn_a"))
    two = undecided.select(F.col("pool").alias("pool_b"), F.col("id").alias("b"), F.col("turn").alias("turn_b"))
    earlier = (level[F.col("pool_b")] < level[F.col("pool_a")]) | ((F.col("pool_a") == F.col("pool_b")) & (F.col("turn_b") < F.col("turn_a")))
    same = one.select("a").distinct().withColumn("b", F.col("a"))
    waits = table(conflicts.select("a", "b").unionByName(same).join(one, "a").join(two, "b").where(earlier).select("pool_a", "a", "pool_b", "b"), "waits")
    room, picked = dict(quotas), []
    while True:
        counts = {r["pool"]: r["n"] for r in undecided.groupBy("pool").agg(F.count("*").alias("n")).collect()}
        open_ = {p: room[p] for p in counts if room[p] > 0}
        if not open_:
            break
        if sum(counts[p] for p in open_) <= LAST_CANDIDATES and waits.count() <= LAST_PAIRS:
            mine = undecided.where(F.col("pool").isin(*open_))
            rows = mine.select("pool", "id", F.row_number().over(Window.partitionBy("pool").orderBy("turn")).alias("k"), F.lit(1).alias("all"))
            run = _walk_left(number, open_)
            last = rows.groupBy("all").cogroup(waits.withColumn("all", F.lit(1)).groupBy("all")).applyInPandas(lambda a, b: run(a, b), "pool string, id long")
            picked.append(table(mine.join(last, ["pool", "id"]).select("pool", "id", "turn"), "picks"))
            discard(undecided, waits)
            break
        free = _first_of_pools(undecided.where(F.col("pool").isin(*open_)), open_).join(waits.select(F.col("pool_a").alias("pool"), F.col("a").alias("id")).distinct(), ["pool", "id"], "left_anti")
        now = table(free.select("pool", "id", "turn"), "picks")
        for r in now.groupBy("pool").agg(F.count("*").alias("n")).collect():
            room[r["pool"]] -= r["n"]
        picked.append(now)
        hit = waits.join(now.select(F.col("pool").alias("pool_b"), F.col("id").alias("b")), ["pool_b", "b"]).select(F.col("pool_a").alias("pool"), F.col("a").alias("id"))
        gone = now.select("pool", "id").unionByName(hit).distinct()
        still = table(undecided.where(F.col("pool").isin(*(p for p in number if room[p] > 0))).join(gone, ["pool", "id"], "left_anti"), "undecided")
        left = table(waits.join(still.select(F.col("pool").alias("pool_a"), F.col("id").alias("a")), ["pool_a", "a"], "left_semi").join(still.select(F.col("pool").alias("pool_b"), F.col("id").alias("b")), ["pool_b", "b"], "left_semi"), "waits")
        discard(undecided, waits)
        undecided, waits = still, left
    out = candidates.select("pool", "id", "turn").limit(0)
    for now in picked:
        out = out.unionByName(now)
    return out


def _decisions(candidates: DataFrame, conflicts: DataFrame, picks: DataFrame, full: Column) -> DataFrame:
    """What the walk says of every candidate ``zone, pool, id, passes, step, turn``, given the picks with their ``step, turn, place``."""
    chosen = picks.select("zone", "pool", "id", F.col("place").alias("own"))
    last = picks.groupBy("zone", "pool").agg(F.max("turn").alias("last_turn"), F.count("*").alias("n_picked"))
    when = F.struct("step", "turn")
    taken = picks.select(F.col("id").alias("b"), when.alias("was"))
    around = conflicts.select("a", "b").unionByName(candidates.select(F.col("id").alias("a")).distinct().withColumn("b", F.col("a")))
    hits = around.join(taken, "b").select(F.col("a").alias("id"), "b", "was")
    first = candidates.join(hits, "id").where(F.col("was") < when).groupBy("zone", "pool", "id").agg(F.min(F.struct(F.when(F.col("b") == F.col("id"), 0).otherwise(1).alias("other"), "was", "b")).alias("hit"))
    rows = candidates.join(chosen, ["zone", "pool", "id"], "left").join(last, ["zone", "pool"], "left").join(first, ["zone", "pool", "id"], "left")
    is_full = (F.coalesce("n_picked", F.lit(0)) >= F.col("quota")) & (F.col("last_turn").isNull() | (F.col("turn") > F.col("last_turn")))
    what = F.when(~F.col("passes"), "filtered").when(F.col("own").isNotNull(), "picked").when(is_full, full).when(F.col("hit.other") == 0, "picked_before").otherwise("blocked")
    rows = rows.withColumn("decision", what)
    by = F.when(F.col("decision").isin("picked_before", "blocked"), F.col("hit.b"))
    return rows.select("zone", "pool", "id", "decision", by.alias("by"), F.when(F.col("decision") == "picked", F.col("own")).alias("place"))


def _zone_by_zone(candidates: DataFrame, conflicts: DataFrame, zones: list[Zone], share: float) -> DataFrame:
    picks, n_all, n_filled = None, 0, 0
    ranked = None
    for step, z in enumerate(zones):
        mine = candidates.where((F.col("zone") == z.zone))
        if picks is not None:
            taken = picks.select("id").distinct()
            hit = conflicts.join(taken.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id")).unionByName(taken).distinct()
            free = mine.join(hit, "id", "left_anti")
        else:
            free = mine
        free = table(free.where("passes").withColumn("turn", F.struct(F.lit(0).alias("side_place"), F.lit(0).alias("state"), F.col("rank"))), "free")
        own = table(pick_with_quotas(free.where(F.col("pool") != FILLER), conflicts, z.quotas), "zone-picks")
        amounts = own.join(free.select("pool", "id", "class_id", "amount"), ["pool", "id"])
        got = {r["class_id"]: (r["n"], r["amount"]) for r in amounts.groupBy("class_id").agg(F.count("*").alias("n"), F.sum("amount").alias("amount")).collect()}
        n_zone = sum(n for n, _ in got.values())
        n_all += n_zone
        room, capped = filler_quota(z, n_zone, n_all, n_filled, share)
        side = F.coalesce(F.array_position(F.array(*map(F.lit, FILLER_SIDES)), F.col("side")), F.lit(0))
        state = F.lit(2)
        for c, w in z.wanted.items():
            state = F.when(F.col("class_id") == c, F.lit(class_state(float(got.get(c, (0, 0))[1] or 0), w))).otherwise(state)
        turn = F.when(F.col("pool") == FILLER, F.struct(F.when(side == 0, len(FILLER_SIDES)).otherwise((side - 1).cast("int")).alias("side_place"), state.cast("int").alias("state"), F.col("rank"))).otherwise(F.struct(F.lit(0).alias("side_place"), F.lit(0).alias("state"), F.col("rank")))
        level = F.create_map(*(x for k, p in enumerate([p for p, _ in z.quotas] + [FILLER]) for x in (F.lit(p), F.lit(step * 1000 + k))))[F.col("pool")]
        most = F.create_map(*(x for p, n in [*z.quotas, (FILLER, room)] for x in (F.lit(p), F.lit(n))))[F.col("pool")]
        mine = table(mine.withColumn("turn", turn).withColumn("step", level).withColumn("quota", most).withColumn("full", F.when((F.col("pool") == FILLER) & F.lit(capped), "national_cap").otherwise("quota_full")).where("step is not null"), "zone-candidates")
        taken = own.select("id").distinct()
        hit = conflicts.join(taken.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id")).unionByName(taken).distinct()
        more = free.where(F.col("pool") == FILLER).select("pool", "id").join(hit, "id", "left_anti").join(mine.select("pool", "id", "turn"), ["pool", "id"])
        filled = table(pick_with_quotas(more, conflicts, [(FILLER, room)]), "zone-picks") if room else None
        n_filled += filled.count() if filled is not None else 0
        new = own if filled is None else own.unionByName(filled)
        new = new.join(mine.select("pool", "id", "zone", "step"), ["pool", "id"]).withColumn("place", F.row_number().over(Window.partitionBy("pool").orderBy("turn")))
        new = table(new.select("zone", "pool", "id", "step", "turn", "place"), "zone-picks")
        picks = new if picks is None else picks.unionByName(new)
        ranked = mine if ranked is None else ranked.unionByName(mine)
    return _decisions(ranked, conflicts, picks, F.col("full"))


def select_nationally(candidates: DataFrame, conflicts: DataFrame, zones: list[Zone], share: float = 0.15) -> DataFrame:
    """The decision log ``zone, pool, id, decision, by, place`` of the selection, a row for each candidate.

    ``candidates`` has ``zone, pool, id, rank`` (no ties within a pool), ``passes`` (its pool's filter), and ``class_id,
    amount, side``; those of the pool ``filler`` are taken last, large cells first, then cells of classes that the zone's picks
    don't have or don't have enough of, then by rank.  ``conflicts`` has pairs ``a, b``, in either or both directions.
    Candidates of zones and pools that ``zones`` doesn't list are left out.

    ``decision`` is ``picked`` (``place`` counts from 1 in its pool), ``filtered``, ``picked_before`` (for another pool),
    ``blocked`` (``by`` is the first pick that it conflicts with), ``quota_full`` or, where fillers reached their
    ``share`` of all picks, ``national_cap``.
    """
    if not zones:
        return candidates.sparkSession.createDataFrame([], LOG)
    both = table(both_directions(conflicts), "conflicts")
    known = [(z.zone, p) for z in zones for p in [*(p for p, _ in z.quotas), FILLER]]
    listed = F.struct("zone", "pool").isin(*(F.struct(F.lit(z).cast("long"), F.lit(p)) for z, p in known))
    rows = candidates.select(F.col("zone").cast("long").alias("zone"), "pool", F.col("id").cast("long").alias("id"), F.coalesce("passes", F.lit(False)).alias("passes"), F.col("class_id").cast("int").alias("class_id"), F.col("amount").cast("double").alias("amount"), F.col("side").cast("int").alias("side"), F.col("rank").cast("long").alias("rank"))
    rows = table(rows.where(listed), "candidates")
    if rows.count() > LAST_CANDIDATES or both.count() > LAST_PAIRS:
        return _zone_by_zone(rows, both, zones, share)
    left, right = rows.withColumn("all", F.lit(1)).groupBy("all"), both.withColumn("all", F.lit(1)).groupBy("all")
    run = _in_one_task(zones, share)
    return left.cogroup(right).applyInPandas(lambda a, b: run(a, b), LOG)


def picks(log: DataFrame) -> DataFrame:
    return log.where("decision = 'picked'")


def deficits(log: DataFrame, quotas: DataFrame) -> DataFrame:
    """Each pool's quota, picks, deficit and the one cause of it, from the decisions on its candidates.

    ``quotas`` has ``zone, pool, quota``.  Causes: ``none`` (no deficit), ``empty_pool`` (no candidates), ``filtered`` (none
    passes), ``national_cap`` (the fillers' share ended it), ``none_free`` (all that pass were picked or blocked), and
    ``exhausted`` (some were picked, the rest was taken or blocked).
    """
    n = lambda *what: F.count(F.when(F.col("decision").isin(*what), 1))
    seen = log.groupBy("zone", "pool").agg(F.count("*").alias("n_candidates"), n("filtered").alias("n_filtered"), n("picked").alias("n_picked"), n("picked_before").alias("n_picked_before"), n("blocked").alias("n_blocked"), n("national_cap").alias("n_capped"))
    all_ = quotas.select(F.col("zone").cast("long").alias("zone"), "pool", F.col("quota").cast("long").alias("quota")).join(seen, ["zone", "pool"], "left").na.fill(0)
    lacks = F.greatest(F.lit(0).cast("long"), F.col("quota") - F.col("n_picked"))
    cause = (
        F.when(F.col("deficit") == 0, "none")
        .when(F.col("n_candidates") == 0, "empty_pool")
        .when(F.col("n_filtered") == F.col("n_candidates"), "filtered")
        .when(F.col("n_capped") > 0, "national_cap")
        .when(F.col("n_picked") == 0, "none_free")
        .otherwise("exhausted")
    )
    return all_.withColumn("deficit", lacks).withColumn("cause", cause)


def zone_audit(log: DataFrame, quotas: DataFrame) -> DataFrame:
    """Picks, fillers, deficit and unassigned budget of each zone, and of all (zone -1)."""
    by_pool = deficits(log, quotas)
    filler = F.col("pool") == FILLER
    figures = [F.sum("n_picked").alias("n_picked"), F.sum(F.when(filler, F.col("n_picked")).otherwise(0)).alias("n_filler"), F.sum(F.when(~filler, F.col("deficit")).otherwise(0)).alias("deficit"), F.sum(F.when(filler, F.col("deficit")).otherwise(0)).alias("unassigned"), F.count(F.when(F.col("n_picked") == 0, 1)).alias("n_empty_pools")]
    return by_pool.groupBy("zone").agg(*figures).unionByName(by_pool.agg(*figures).withColumn("zone", F.lit(-1).cast("long")))
