"""Exact percentiles, smoothing and keyed sweeps against numpy and single runs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapanel.operators import graph
from terrapanel.operators.percentiles import exact_percentiles, weighted_percentiles
from terrapanel.operators.superpixels import superpixels
from terrapanel.operators import sweep
from terrapanel.operators.sweep import parameter_sweep, smooth

SHARES = (0.0, 0.05, 0.333, 0.5, 0.9, 1.0)


@pytest.mark.parametrize("seed", range(2))
def test_percentiles_equal_numpy(spark, seed):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), rng.choice([rng.gauss(0, 1), rng.randrange(4), None])) for _ in range(600)] + [("none", None)]
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows], "g string, v double").repartition(5)
    want = {(g, s): np.percentile([v for k, v in rows if k == g and v is not None], 100 * s) for g in ("hot", "a", "b", "c") for s in SHARES}
    got = {(r.g, r.share): r.value for r in exact_percentiles(df, "v", SHARES, ["g"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    whole = {r.share: r.value for r in exact_percentiles(df, "v", SHARES).collect()}
    assert all(abs(whole[s] - np.percentile([v for _, v in rows if v is not None], 100 * s)) < 1e-12 for s in SHARES)
    assert exact_percentiles(df.where(F.lit(False)), "v", SHARES).collect() == []


def test_no_task_holds_all_values(spark):
    plan = exact_percentiles(spark.range(1000).select(F.col("id").cast("double").alias("v")), "v", [0.5])._jdf.queryExecution().toString().lower()
    assert "percentile(" not in plan and "part" in plan


def test_weighted_percentiles(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.randrange(12) / 2, rng.randrange(5)) for _ in range(200)]
    got = {(r.g, r.share): r.value for r in weighted_percentiles(spark.createDataFrame(rows, "g int, v double, w int"), "v", "w", (0.1, 0.5, 1.0), ["g"]).collect()}
    for (g, share), value in got.items():
        mine = sorted((v, w) for k, v, w in rows if k == g and w)
        upto, total = 0, sum(w for _, w in mine)
        for v, w in mine:
            upto += w
            if upto >= share * total:
                assert v == value
                break
    assert len(got) == 6


def test_smoothing_is_a_bell_over_what_is_there(spark):
    rng = random.Random(4)
    px = {(r, c): rng.random() for r in range(9) for c in range(7) if rng.random() < 0.8}
    df = spark.createDataFrame([(s, r, c, v) for s in (0.0, 1.0) for (r, c), v in px.items()], "sigma double, px_row int, px_col int, v double")
    got = {(x.sigma, x.px_row, x.px_col): x.v for x in smooth(df, ["v"], ["sigma"], F.col("sigma"), 1.0).collect()}
    bell = lambda d: math.exp(-d * d / 2) if abs(d) <= 3 else 0.0
    for (r, c), v in px.items():
        w = {k: bell(k[0] - r) * bell(k[1] - c) for k in px}
        assert abs(got[1.0, r, c] - sum(w[k] * px[k] for k in px) / sum(w.values())) < 1e-12 and got[0.0, r, c] == v


def test_a_sweep_is_its_single_runs(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(r, c, float(rng.randrange(5) * 20)) for r in range(10) for c in range(12)], "px_row int, px_col int, v double")
    out = {(r.scale, r.percentile): r for r in parameter_sweep(df, ["v"], [9, 16], [0.0], [0.25, 0.6], rounds=2, least=6).collect()}
    assert len(out) == 4
    for scale in (9, 16):
        nodes, edges = graph.region_graph(superpixels(df, ["v"], math.isqrt(scale), 2), "segment", ["v"])
        for p in (0.25, 0.6):
            merged = graph.cut_and_merge(nodes, edges, "segment", p).join(nodes.select("segment", "n"), "segment").groupBy("merged").agg(F.sum("n").alias("n")).collect()
            r = out[scale, p]
            assert (r.n_segments, r.n_edges, r.n_regions, r.largest_px, r.n_small) == (nodes.count(), edges.count(), len(merged), max(m.n for m in merged), sum(m.n < 6 for m in merged))


def test_a_sweep_leaves_out_what_is_done(spark):
    df = spark.createDataFrame([(r, c, float(c)) for r in range(6) for c in range(6)], "px_row int, px_col int, v double")
    first = parameter_sweep(df, ["v"], [9], [0.0], [0.5], rounds=1).withColumn("n_small", F.lit(-1).cast("long"))
    again = parameter_sweep(df, ["v"], [9], [0.0], [0.5, 0.9], rounds=1, done=first).collect()
    assert sorted((r.percentile, r.n_small == -1) for r in again) == [(0.5, True), (0.9, False)]
    assert parameter_sweep(df, ["v"], [9], [0.0], [0.5], done=first) is first


def test_smoothing_is_worked_out_once_for_each_deviation(spark, monkeypatch):
    written, whole = [], sweep.table

    def spy(df, name, *rest):
        out = whole(df, name, *rest)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(sweep, "table", spy)
    df = spark.createDataFrame([(r, c, float(r // 4 * 10 + c // 4)) for r in range(8) for c in range(8)], "px_row int, px_col int, v double")
    out = parameter_sweep(df, ["v"], [4, 9, 16], [0.0], [0.5], rounds=1)
    assert {r.scale for r in out.collect()} == {4, 9, 16}
    assert [n for name, n in written if name == "images"] == [64, 64]
