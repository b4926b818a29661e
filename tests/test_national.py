"""The national selection, its deficits and its acceptance rules against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from terrapanel.operators import acceptance, national

CANDIDATES = "zone long, pool string, id long, passes boolean, class_id int, amount double, side int, rank long"


def problem(seed):
    """Zones that share conflicts, quotas that fill, and cells in several pools."""
    rng = random.Random(seed)
    cells = {i: (rng.randrange(3), rng.randrange(4), rng.randint(1, 9), rng.choice([2, 3, 3, 4])) for i in range(70)}
    edges = {tuple(sorted(rng.sample(range(70), 2))) for _ in range(60)}
    rows = []
    for i, (zone, c, amount, side) in cells.items():
        for pool in ["a", "b", "c"]:
            if rng.random() < 0.5:
                rows.append((zone, pool, i, rng.random() < 0.8, c, float(amount), side))
        rows.append((zone, "filler", i, rng.random() < 0.9, c, float(amount), side))
    ranks = rng.sample(range(10**6), len(rows))
    zones = [national.Zone(z, [("a", 4), ("b", 3), ("c", rng.choice([0, 2]))], 14, {0: 6.0, 1: 20.0, 2: 0.0}) for z in (2, 0, 1)]
    return [(*r, k) for r, k in zip(rows, ranks, strict=True)], sorted(edges), zones


def loop(rows, edges, zones, share):
    """Cell by cell, as one would write it down."""
    taken, out, n_all, n_filled = [], {}, 0, 0
    near = lambda i, j: (i, j) in edges or (j, i) in edges

    def walk(zone, pool, order, quota, full):
        got = []
        for r in order:
            i = r[2]
            if not r[3]:
                out[zone, pool, i] = ("filtered", None, None)
            elif len(got) >= quota:
                out[zone, pool, i] = (full, None, None)
            elif i in taken:
                out[zone, pool, i] = ("picked_before", i, None)
            elif hit := [j for j in taken if near(i, j)]:
                out[zone, pool, i] = ("blocked", hit[0], None)
            else:
                taken.append(i)
                got.append(r)
                out[zone, pool, i] = ("picked", None, len(got))
        return got

    for z in zones:
        own = []
        for pool, quota in z.quotas:
            own += walk(z.zone, pool, sorted((r for r in rows if r[0] == z.zone and r[1] == pool), key=lambda r: r[7]), quota, "quota_full")
        n_all += len(own)
        lacks, left = max(0, z.most - len(own)), max(0, int(share / (1 - share) * n_all + 1e-9) - n_filled)
        amount = {c: sum(r[5] for r in own if r[4] == c) for c in range(4)}
        state = lambda c, z=z, amount=amount: 2 if amount[c] >= z.wanted.get(c, 0) or z.wanted.get(c, 0) <= 0 else 1 if amount[c] else 0
        order = sorted((r for r in rows if r[0] == z.zone and r[1] == "filler"), key=lambda r: ({3: 0, 2: 1}.get(r[6], 2), state(r[4]), r[7]))
        n_filled += len(walk(z.zone, "filler", order, min(lacks, left), "national_cap" if left < lacks else "quota_full"))
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("rounds", [False, True])
def test_selection_is_the_loop(spark, monkeypatch, seed, rounds):
    rows, edges, zones = problem(seed)
    if rounds:
        monkeypatch.setattr(national, "LAST_PAIRS", 0)
    log = national.select_nationally(spark.createDataFrame(rows, CANDIDATES), spark.createDataFrame(edges, "a long, b long"), zones, 0.3)
    got = {(r.zone, r.pool, r.id): (r.decision, r.by, r.place) for r in log.collect()}
    want = loop(rows, set(edges), zones, 0.3)
    assert got == want
    assert {"picked", "filtered", "blocked", "picked_before", "quota_full"} <= {v[0] for v in want.values()}


def test_a_full_quota_blocks_nobody(spark, monkeypatch):
    rows = [(0, "a", 1, True, 0, 1.0, 2, 1), (0, "a", 5, True, 0, 1.0, 2, 2), (1, "a", 6, True, 0, 1.0, 2, 3)]
    zones = [national.Zone(z, [("a", 1)], 1) for z in (0, 1)]
    for last in (10**6, 0):
        monkeypatch.setattr(national, "LAST_PAIRS", last)
        log = national.select_nationally(spark.createDataFrame(rows, CANDIDATES), spark.createDataFrame([(5, 6)], "a long, b long"), zones)
        assert {r.id for r in national.picks(log).collect()} == {1, 6}


def test_selection_of_nothing(spark, monkeypatch):
    none, edges = spark.createDataFrame([], CANDIDATES), spark.createDataFrame([], "a long, b long")
    assert national.select_nationally(none, edges, []).collect() == []
    rows = spark.createDataFrame([(0, "a", 1, None, 0, 1.0, 2, 1), (0, "other", 2, True, 0, 1.0, 2, 1)], CANDIDATES)
    assert [tuple(r) for r in national.select_nationally(rows, edges, [national.Zone(0, [("a", 1)], 1)]).collect()] == [(0, "a", 1, "filtered", None, None)]


def test_each_deficit_has_one_cause(spark):
    log = [(0, "a", 1, "picked"), (0, "a", 2, "blocked"), (0, "b", 3, "filtered"), (0, "c", 1, "picked_before"), (0, "filler", 4, "national_cap"), (0, "filler", 5, "filtered"), (0, "e", 6, "picked")]
    quotas = [(0, p, q) for p, q in (("a", 2), ("b", 1), ("c", 1), ("d", 3), ("e", 1), ("filler", 1))]
    got = national.deficits(spark.createDataFrame(log, "zone long, pool string, id long, decision string"), spark.createDataFrame(quotas, "zone long, pool string, quota long")).collect()
    assert {r.pool: (r.deficit, r.cause) for r in got} == {"a": (1, "exhausted"), "b": (1, "filtered"), "c": (1, "none_free"), "d": (3, "empty_pool"), "e": (0, "none"), "filler": (1, "national_cap")}


def test_acceptance_tells_what_it_cannot_judge(spark):
    rows = [(z, c, s, k, u) for z, c, s, k, u in ((1, 3, "train", 1, False), (1, 3, "train", 1, False), (1, 0, "val", 2, False), (2, 4, "val", 3, True))]
    tables = {
        "selection": spark.createDataFrame(rows, "zone int, target_class int, split string, cluster int, unfeasible boolean"),
        "layers": spark.createDataFrame([(18, 32718)], "utm int, epsg int"),
        "universe": spark.createDataFrame([], "class_id int"),
        "report": spark.createDataFrame([("areas",)], "name string"),
    }
    got = {r.test: r for r in acceptance.evaluate(spark, tables, acceptance.selection_rules()).collect()}
    assert len(got) == len(acceptance.selection_rules())
    results = {k: r.result for k, r in got.items()}
    assert results["1"] == results["CRS18"] == results["24"] == "PASS"
    assert results["2"] == results["8"] == results["13"] == "FAIL" and results["12"] == "PASS"
    assert results["CRS19"] == results["15"] == results["16"] == results["21"] == "NOT-EVALUABLE"
    assert got["15"].detail == "missing: selection.pool" and got["16"].detail == "missing: grid, selection.side" and got["13"].detail == "E2:0"
    assert got["8"].detail == "E1:val=1 test=0" and got["2"].value == 1


def test_every_rule_can_fail(spark):
    f = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = {
        "selection": f([(1, 0, "val", 1, False, "filler", 3, "census", 49.0)], "zone int, target_class int, split string, cluster int, unfeasible boolean, pool string, side int, mode string, ha double"),
        "universe": f([(27,), (26,)], "class_id int"), "grid": f([(2,), (2,)], "side int"), "leaks": f([(1, 2)], "zone int, n int"), "layers": f([(18, 4326), (19, 4326)], "utm int, epsg int"),
        "coverage": f([("census", None), ("standard", 1.2)], "mode string, share double"), "overlap": f([(10.0, 9.0, 1)], "sum_area double, union_area double, n_pairs int"), "report": f([], "name string"),
    }
    assert {r.result for r in acceptance.evaluate(spark, tables, acceptance.selection_rules()).collect()} == {"FAIL"}
    assert acceptance.evaluate(spark, {"selection": tables["selection"].where(F.lit(False))}, [acceptance.within("b", "", "selection", ["side"], F.col("side") == 3, 0, 2)]).first().result == "PASS"


def test_few_undecided_candidates_are_decided_without_rounds(spark, monkeypatch):
    """A chain in which each waits for the one before would take a round for every two; cells of two pools are taken once."""
    rows = [("a", k, k) for k in range(40)] + [("b", k, -k) for k in range(60)]
    edges = [(k, k + 1) for k in range(59)]
    cells = spark.createDataFrame(rows, "pool string, id long, rank long").selectExpr("pool", "id", "struct(rank) AS turn")
    both = spark.createDataFrame(edges + [(b, a) for a, b in edges], "a long, b long")
    want, taken = [], set()
    for pool, room in (("a", 12), ("b", 25)):
        for _, id_ in sorted((r, i) for p, i, r in rows if p == pool):
            if room and not taken & {id_ - 1, id_, id_ + 1}:
                taken.add(id_)
                want.append((pool, id_))
                room -= 1
    quotas = [("a", 12), ("b", 25)]
    with monkeypatch.context() as m:
        m.setattr(national, "_first_of_pools", None)
        got = national.pick_with_quotas(cells, both, quotas).collect()
    assert sorted((r["pool"], r["id"]) for r in got) == sorted(want)
    assert {r["turn"]["rank"] for r in got if r["pool"] == "b"} == {-i for p, i in want if p == "b"}
