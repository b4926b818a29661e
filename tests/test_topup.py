"""Filling passes, reserves, rare-class picks, label repair and splits against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from terrapanel.operators import national, topup

LIMITS = topup.Limits(6, 4, 60, (30, 60), 4, 6, 1.2, (2, 5), 50, 2, 2, 9, 4, 50)
CELLS = "id long, zone long, class_id int, mixed boolean, score double, transition_pct double, stable_years array<int>, rare string, exempt boolean"


def cells(seed, n=80):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(1, 4), rng.randrange(4), rng.random() < 0.5, float(rng.randrange(9)), rng.choice([None, 1.0, 8.0]), [rng.randrange(4) for _ in range(4)] if rng.random() < 0.5 else [0, 1], rng.choice([None, "", "r"]), rng.choice([None, True, False])) for i in range(n)]
    return rows, sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(70)})


def kind(r):
    return "transicion" if (r[5] or 0) >= 8 else "anual" if any(x >= 2 for x in r[6]) else "estable"


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("last", [10**6, 0])
def test_zones_are_filled_as_the_loop_does(spark, monkeypatch, seed, last):
    monkeypatch.setattr(national, "LAST_PAIRS", last)
    rows, edges = cells(seed)
    near = {x for e in edges for x in (e, e[::-1])}
    selected = [(r[0], r[1], r[2], ["anual", "estable"][r[0] % 2]) for r in rows[::9]]
    own = {s[0] for s in selected}
    free = [r for r in rows if r[0] not in own and not (r[1] in (1, 2) and r[2] == 0 and not r[8]) and not (r[2] == 3 and not (r[7] or "").strip())]
    have = {z: [s for s in selected if s[1] == z] for z in (1, 2, 3)}
    taken, added = set(own), []
    for z in sorted(have, key=lambda z: (z != 3, len(have[z]), z)):
        prio = lambda r, z=z: 2 * (kind(r) not in {s[3] for s in have[z]}) + (r[2] not in {s[2] for s in have[z]}) - (r[2] == 0)
        k = 0
        for r in sorted((r for r in free if r[1] == z), key=lambda r: (-prio(r), -r[3], -r[4], r[0])):
            if k >= 9 - len(have[z]) or len(added) >= 11:
                break
            if r[0] not in taken and not any((r[0], t) in near for t in taken):
                taken.add(r[0])
                k += 1
                added.append((r[0], z, k, f"{kind(r)}_simple_media", kind(r), "simple_media"))
    df = spark.createDataFrame(rows, CELLS)
    sel, con = spark.createDataFrame(selected, "id long, zone long, class_id int, dim_temporal string"), spark.createDataFrame(edges, "a long, b long")
    pool = topup.fill_candidates(df, sel, 0, (1, 2), 3)
    got = topup.fill_zone_minimum(sel, pool, con, 9, (3,), 11, 0)
    assert sorted(map(tuple, got.collect())) == sorted(added) and len(added) > 5
    more = []
    for r in sorted(free, key=lambda r: (-r[3], -r[4], r[0])):
        if len(selected) + len(more) < 16 and not any((r[0], t) in near for t in own):
            own.add(r[0])
            plain = "simple_media" if kind(r) == "transicion" or r[3] else "homogenea"
            more.append((r[0], r[1], len(more) + 1, f"{kind(r)}_{plain}", kind(r), plain))
    assert sorted(map(tuple, topup.fill_to_total(sel, pool, con, 16).collect())) == sorted(more)
    assert topup.fill_to_total(sel, pool, con, 3).collect() == []


def test_reserves_for_fragile_zones_only(spark):
    rows, _ = cells(3)
    df = spark.createDataFrame(rows, CELLS)
    sel = df.where("zone = 1 OR (zone = 2 AND id % 20 = 0)").select("id", "zone")
    got = {(r.zone, r.place): r.id for r in topup.reserves(sel, df, (1, 2), 3).collect()}
    want = sorted((r for r in rows if r[1] == 2 and r[0] % 20), key=lambda r: (-r[3], -r[4], r[0]))[:3]
    assert got == {(2, k): r[0] for k, r in enumerate(want, 1)}


def test_rare_picks_are_topped_up(spark):
    rows = [(i, 1 if i < 8 else 2, float(i % 5), False, 0.0, 0, 0.0, 0.0, 0.0, [0, 0]) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, zone int, score double, mixed boolean, transition_pct double, n_classes int, mode_pct double, diversity double, max_run double, stable_years array<int>")
    got = {r.id: r.topped_up for r in topup.rare_class_pick(df, [F.desc("score"), F.asc("id")], 2, 6, LIMITS).collect()}
    assert got == {4: False, 3: False, 9: False, 8: False, 2: True, 7: True}
    assert len(topup.rare_class_pick(df, [F.desc("score"), F.asc("id")], 2, 3, LIMITS).collect()) == 3


def test_types_of_rare_cells(spark):
    rows = [(True, 9.0, 4, 40.0, [0, 0], "transicion_simple_media"), (True, 9.0, 3, 40.0, [3, 3], "transicion_homogenea"), (False, 0.0, 0, 70.0, [1, 2], "anual_homogenea"), (True, 0.0, 0, 70.0, [2, 0], "anual_simple_media"), (False, 0.0, 0, 70.0, [2, 1], "estable_homogenea"), (True, 0.0, 0, 70.0, [0, 0], "estable_simple_media")]
    df = spark.createDataFrame([(*r, 9.0, 1.0) for r in rows], "mixed boolean, transition_pct double, n_classes int, mode_pct double, stable_years array<int>, want string, max_run double, diversity double")
    assert all(r.t == r.want for r in df.withColumn("t", topup.rare_type(LIMITS)).collect())


def test_labels_are_repaired_at_falling_thresholds(spark):
    none, row = [[], []], lambda i, kind, space, run, share, change, steady, years, mixed=False, n=3: (i, kind, kind.split("_")[0], space, mixed, run, share, change, steady, 1.0, n, years)
    rows = [
        row("a", "anual_homogenea", "homogenea", 7, 70, 1, 60, [[2001, 2002]]),  # stable enough
        row("b", "anual_simple_media", "simple_media", 0, 0, 9, 0, [[1999], [2001, 2002]]),  # the first: its last year
        row("c", "anual_simple_media", "simple_media", 0, 0, 9, 0, [[2002], []]),  # only with one year
        row("d", "anual_simple_media", "simple_media", 0, 0, 9, 0, [[2001, 2002], [1999, 2000]]),  # least used, by its letter
        row("e", "anual_homogenea", "homogenea", 7, 70, 1, 0, none), row("f", "anual_simple_media", "simple_media", 5, 40, 1, 0, none, True), row("g", "anual_simple_media", "simple_media", 5, 70, 1, 0, none, True),
        row("h", "estable_homogenea", "homogenea", 0, 0, 0, 0, none),
    ]
    df = spark.createDataFrame(rows, "id string, sample_type string, dim_temporal string, dim_espacial string, mixed boolean, max_run int, mode_pct int, transition_pct int, stable_pct int, diversity double, n_classes int, years array<array<int>>")
    got = {r.id: (r.sample_type, r.dim_temporal, r.ref_year) for r in topup.repair_labels(df, [F.asc("id")], LIMITS).collect()}
    d = [1999, 2000, 2001][ord("d") % 3]
    assert got == {"a": ("estable_homogenea", "estable", -9999), "b": ("anual_simple_media", "anual", 2002), "c": ("anual_simple_media", "anual", 2002), "d": ("anual_simple_media", "anual", d), "e": ("estable_homogenea", "estable", -9999), "f": ("estable_simple_media", "estable", -9999), "h": ("estable_homogenea", "estable", -9999)}
    assert topup.repair_labels(df.limit(0), [F.asc("id")], LIMITS).collect() == []


def test_small_strata(spark):
    df = spark.createDataFrame([(n, i) for n in (1, 2, 3, 10, 30) for i in range(n)], "n int, id int")
    got = {}
    for r in topup.stratified_split(df, ["n"], "id", F.col("id")).collect():
        got.setdefault(r.n, {}).setdefault(r.split, []).append(r.id)
    assert {n: {k: len(v) for k, v in x.items()} for n, x in got.items()} == {1: {"train": 1}, 2: {"train": 1, "val": 1}, 3: {"train": 1, "val": 1, "test": 1}, 10: {"train": 6, "val": 2, "test": 2}, 30: {"train": 22, "val": 4, "test": 4}}
    assert max(got[30]["train"]) < min(got[30]["val"])
