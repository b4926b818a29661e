"""Merging of regions in order, and superpixels in one part each, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terrapanel.operators import graph, merging
from terrapanel.operators.superpixels import assign_to_seeds, connect_segments, superpixels


def graph_of(seed, n=24):
    """Regions with whole sums of bands (a mean times pixels is exact), several connected parts, one region on its own."""
    rng = random.Random(seed)
    nodes = {r: (rng.choice([1, 2, 4, 8]), rng.randrange(40), rng.randrange(40)) for r in range(n)}
    pairs = {tuple(sorted(rng.sample(range(0, n // 2), 2))) for _ in range(20)} | {tuple(sorted(rng.sample(range(n // 2, n - 1), 2))) for _ in range(14)}
    return nodes, pairs


def frames(spark, nodes, pairs):
    return spark.createDataFrame([(r, n, float(x), float(y)) for r, (n, x, y) in nodes.items()], "region long, n long, x double, y double"), spark.createDataFrame(sorted(pairs), "a long, b long")


class Plain:
    def __init__(self, nodes, pairs):
        self.n = {r: v[0] for r, v in nodes.items()}
        self.sum = {r: (v[0] * v[1], v[0] * v[2]) for r, v in nodes.items()}
        self.edges, self.to = set(pairs), {r: r for r in nodes}

    def weight(self, a, b):
        return math.dist([x / self.n[a] for x in self.sum[a]], [x / self.n[b] for x in self.sum[b]])

    def merge(self, gone, into):
        self.n[into] += self.n.pop(gone)
        self.sum[into] = tuple(x + y for x, y in zip(self.sum[into], self.sum.pop(gone)))
        self.edges = {tuple(sorted((into if a == gone else a, into if b == gone else b))) for a, b in self.edges}
        self.edges = {(a, b) for a, b in self.edges if a != b}
        self.to = {r: into if t == gone else t for r, t in self.to.items()}


@pytest.mark.parametrize("seed", range(4))
def test_nearest_pairs_merge_in_order(spark, seed):
    nodes, pairs = graph_of(seed)
    p = Plain(nodes, pairs)
    while p.edges:
        w, a, b = min((p.weight(a, b), a, b) for a, b in p.edges)
        if w >= 12:
            break
        p.merge(b, a)
    got = dict(merging.merge_in_order(*frames(spark, nodes, pairs), ["x", "y"], 12.0).collect())
    assert got == p.to and len(set(got.values())) < len(nodes)


@pytest.mark.parametrize("seed", range(4))
def test_smallest_regions_are_absorbed_in_order(spark, seed):
    nodes, pairs = graph_of(seed)
    p = Plain(nodes, pairs)
    while small := sorted((n, r) for r, n in p.n.items() if n < 7 and any(r in e for e in p.edges)):
        r = small[0][1]
        p.merge(r, min((p.weight(r, b if a == r else a), b if a == r else a) for a, b in p.edges if r in (a, b))[1])
    got = {r.region: (r.merged, r.resolved) for r in merging.absorb_in_order(*frames(spark, nodes, pairs), ["x", "y"], 7).collect()}
    assert got == {r: (t, p.n[t] >= 7) for r, t in p.to.items()}


def test_large_parts_merge_in_rounds(spark, monkeypatch):
    """Where no merged mean comes nearer to a neighbour, rounds end where the order does."""
    nodes = {r: (1, x, 0) for r, x in enumerate([0, 1, 10, 12, 40, 43, 100])}
    pairs = {(r, r + 1) for r in range(6)}
    want = dict(merging.merge_in_order(*frames(spark, nodes, pairs), ["x", "y"], 5.0).collect())
    monkeypatch.setattr(merging, "LAST_REGIONS", 3)
    assert dict(merging.merge_in_order(*frames(spark, nodes, pairs), ["x", "y"], 5.0).collect()) == want == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, 6: 6}
    lone = merging.absorb_in_order(*frames(spark, nodes, set()), ["x", "y"], 2).collect()
    assert [(r.merged, r.resolved) for r in sorted(lone)] == [(r, False) for r in range(7)]


def parts_of(cells):
    """Connected parts, each by its smallest pixel, of a map from pixels to values."""
    out = {}
    for start in sorted(cells):
        if start in out:
            continue
        todo = [start]
        out[start] = start
        while todo:
            r, c = todo.pop()
            for x in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if x in cells and x not in out and cells[x] == cells[start]:
                    out[x] = start
                    todo.append(x)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_fragments_join_the_longest_border(spark, seed):
    rng = random.Random(seed)
    cells = {(r, c): rng.choice("aab") if rng.random() < 0.3 else "abcd"[(r // 4) * 2 + c // 5] for r in range(8) for c in range(10) if rng.random() < 0.93}
    part = parts_of(cells)
    size = {p: sum(q == p for q in part.values()) for p in set(part.values())}
    owner = {(b := min((p for p in size if cells[p] == v), key=lambda p: (-size[p], p))): b for v in set(cells.values())}
    while True:
        new = {}
        for p in set(size) - set(owner):
            n = {}
            for (r, c), q in part.items():
                if q == p:
                    for x in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                        if x in part and part[x] in owner:
                            n[owner[part[x]]] = n.get(owner[part[x]], 0) + 1
            if n:
                new[p] = min(n, key=lambda o: (-n[o], o))
        if not new:
            break
        owner |= new
    want = {x: owner.get(p, p) for x, p in part.items()}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in cells.items()], "px_row int, px_col int, v string")
    got = {(r.px_row, r.px_col): divmod(r.segment, 1 << 32) for r in connect_segments(df, "v").collect()}
    assert got == want


def test_superpixels_are_one_part_each(spark):
    rng = random.Random(5)
    rows = [(r, c, float(rng.randrange(3) * 50)) for r in range(12) for c in range(15)]
    df = spark.createDataFrame(rows, "px_row int, px_col int, v double")
    seeds = assign_to_seeds(df, ["v"], 4, 2).withColumn("id", F.col("px_row") * 100 + F.col("px_col"))
    n_parts = graph.patches(seeds, "seed", 4).select("patch").distinct().count()
    out = superpixels(df, ["v"], 4, 2).withColumn("id", F.col("px_row") * 100 + F.col("px_col"))
    final = graph.patches(out, "segment", 4).groupBy("segment").agg(F.count_distinct("patch").alias("n"), F.count("*").alias("px")).collect()
    assert {r.n for r in final} == {1} and sum(r.px for r in final) == len(rows) and n_parts > len(final)
