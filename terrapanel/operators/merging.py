"""Merging of regions, in order or in rounds, and spaced picks of points.

Merging by the distance of means can bring a merged region nearer to its neighbours than either of the two was, so rounds of
mutual nearest neighbours need not end where merging the nearest pair of all, one after the other, does.  Regions that no chain
of neighbours connects never affect each other; so each connected part of the graph is merged in order by a task of its own.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.functions.geodesy import geodesic_m
from terrapanel.operators.components import LAST_EDGES, connected_components
from terrapanel.operators.selection import independent_prefix
from terrapanel.operators.topup import first_of_groups
from terrapanel.sources.shared import discard, table


def _weights(nodes: DataFrame, pairs: DataFrame, bands: Sequence[str]) -> DataFrame:
    left = nodes.select(F.col("region").alias("a"), *(F.col(b).alias(f"a_{b}") for b in bands))
    right = nodes.select(F.col("region").alias("b"), *(F.col(b).alias(f"b_{b}") for b in bands))
    d = sum((F.pow(F.col(f"a_{b}") - F.col(f"b_{b}"), 2) for b in bands), F.lit(0.0))
    return pairs.join(left, "a").join(right, "b").select("a", "b", F.sqrt(d).alias("weight"))


def _merged(nodes: DataFrame, pairs: DataFrame, links: DataFrame, bands: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes and pairs after the regions that links connect became one, and the map from old to new."""
    new = nodes.select("region").join(connected_components(links, "a", "b", LAST_EDGES).select(F.col("node").alias("region"), "component"), "region", "left").withColumn("to", F.coalesce("component", "region")).select("region", "to")
    new = table(new, "merge")
    grown = nodes.join(new, "region").groupBy("to").agg(F.sum("n").alias("n"), *((F.sum(F.col(b) * F.col("n")) / F.sum("n")).alias(b) for b in bands)).withColumnRenamed("to", "region")
    kept = pairs.join(new.select(F.col("region").alias("a"), F.col("to").alias("ta")), "a").join(new.select(F.col("region").alias("b"), F.col("to").alias("tb")), "b")
    kept = kept.where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
    return table(grown, "nodes"), table(kept, "pairs"), new


def _next_round(total: DataFrame, nodes: DataFrame, pairs: DataFrame, links: DataFrame, bands: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What regions have become after one more round, with the merged regions and pairs; earlier tables go."""
    grown, kept, new = _merged(nodes, pairs, links, bands)
    now = table(total.join(new.select(F.col("region").alias("merged"), "to"), "merged").select("region", F.col("to").alias("merged")), "total")
    discard(total, nodes, pairs, new)
    return now, grown, kept


def merge_mutual_nearest(nodes: DataFrame, pairs: DataFrame, bands: Sequence[str], limit: float) -> DataFrame:
    """``region, merged``: regions merge with their nearest neighbour, where both are each other's, while nearer than ``limit``.

    After each round the means are those of the merged regions.  The nearest pair of all is always
    mutual, so the rounds go on until no edge is under the limit.
    """
    nodes, pairs = table(nodes, "nodes"), table(pairs.select("a", "b").distinct(), "pairs")
    total = table(nodes.select("region", F.col("region").alias("merged")), "total")
    while True:
        close = _weights(nodes, pairs, bands).where(F.col("weight") < limit)
        both = close.unionByName(close.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
        best = both.groupBy("a").agg(F.min_by("b", F.struct("weight", F.least("a", "b"), F.greatest("a", "b"))).alias("b"))
        best = table(best, "nearest")
        links = best.alias("x").join(best.alias("y"), F.expr("x.a = y.b and x.b = y.a and x.a < x.b")).select("x.a", "x.b")
        if not links.take(1):
            return total
        total, nodes, pairs = _next_round(total, nodes, pairs, links, bands)
        discard(best)


def absorb_small(nodes: DataFrame, pairs: DataFrame, bands: Sequence[str], least: int) -> DataFrame:
    """``region, merged``: regions under ``least`` pixels join their most similar neighbour, chains together, until none can."""
    nodes, pairs = table(nodes, "nodes"), table(pairs.select("a", "b").distinct(), "pairs")
    total = table(nodes.select("region", F.col("region").alias("merged")), "total")
    while True:
        w = _weights(nodes, pairs, bands)
        both = w.unionByName(w.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
        small = nodes.where(F.col("n") < least).select(F.col("region").alias("a"))
        links = table(both.join(small, "a").groupBy("a").agg(F.min_by("b", F.struct("weight", "b")).alias("b")), "absorb")
        if not links.take(1):
            return total
        total, nodes, pairs = _next_round(total, nodes, pairs, links, bands)
        discard(links)


#: So many regions of one connected part fit one task; larger parts are merged in rounds.
LAST_REGIONS = 200_000


class _Regions:
    """Regions of one connected part: pixels, sums of bands, neighbours."""

    def __init__(self, rows: pd.DataFrame, n_bands: int):
        nodes, pairs = rows[rows["b"].isna()], rows[rows["b"].notna()]
        self.n = dict(zip(nodes["a"].tolist(), nodes["n"].tolist(), strict=True))
        self.sums = dict(zip(self.n, zip(*(nodes[f"v{k}"].tolist() for k in range(n_bands)), strict=True), strict=True))
        self.near: dict[int, set[int]] = {r: set() for r in self.n}
        for a, b in zip(pairs["a"].tolist(), pairs["b"].astype("int64").tolist(), strict=True):
            self.near[a].add(b)
            self.near[b].add(a)
        self.to = {r: r for r in self.n}

    def weight(self, a: int, b: int) -> float:
        return math.sqrt(sum((x / self.n[a] - y / self.n[b]) * (x / self.n[a] - y / self.n[b]) for x, y in zip(self.sums[a], self.sums[b], strict=True)))

    def merge(self, gone: int, into: int) -> None:
        self.n[into] += self.n.pop(gone)
        self.sums[into] = tuple(x + y for x, y in zip(self.sums[into], self.sums.pop(gone), strict=True))
        for r in self.near.pop(gone):
            self.near[r].discard(gone)
            if r != into:
                self.near[r].add(into)
                self.near[into].add(r)
        self.to[gone] = into

    def final(self, region: int) -> int:
        while self.to[region] != region:
            self.to[region] = self.to[self.to[region]]
            region = self.to[region]
        return region


def _nearest_first(regions: _Regions, limit: float) -> None:
    """Merges the nearest pair of all (ties to the smallest regions) into the smaller region until none is under the limit."""
    heap = [(regions.weight(a, b), a, b) for a in regions.near for b in regions.near[a] if a < b]
    heapq.heapify(heap)
    while heap and heap[0][0] < limit:
        w, a, b = heapq.heappop(heap)
        if b not in regions.near.get(a, ()) or regions.weight(a, b) != w:
            continue
        regions.merge(b, a)
        for r in regions.near[a]:
            heapq.heappush(heap, (regions.weight(a, r), min(a, r), max(a, r)))


def _smallest_first(regions: _Regions, least: int) -> None:
    """The smallest region (ties by name) joins its most similar neighbour until none is under ``least`` that has one."""
    heap = [(n, r) for r, n in regions.n.items() if n < least]
    heapq.heapify(heap)
    while heap:
        n, r = heapq.heappop(heap)
        if regions.n.get(r) != n or not regions.near[r]:
            continue
        into = min(regions.near[r], key=lambda x: (regions.weight(r, x), x))
        regions.merge(r, into)
        if regions.n[into] < least:
            heapq.heappush(heap, (regions.n[into], into))


def _by_part(nodes: DataFrame, pairs: DataFrame, bands: Sequence[str], merge, in_rounds) -> DataFrame:
    """``region, merged, n_px`` (pixels of the merged region): ``merge`` on each connected part, ``in_rounds`` on the large."""
    nodes, pairs = table(nodes, "nodes"), table(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "pairs")
    part = connected_components(pairs, "a", "b", LAST_EDGES).select(F.col("node").alias("region"), F.col("component").alias("part"))
    whole = table(nodes.join(part, "region", "left").withColumn("part", F.coalesce("part", "region")), "regions")
    large = whole.groupBy("part").agg(F.count("*").alias("n_regions")).where(F.col("n_regions") > LAST_REGIONS).select("part")
    sums = [(F.col(b) * F.col("n")).alias(f"v{k}") for k, b in enumerate(bands)]
    none = [F.lit(None).cast("double").alias(f"v{k}") for k in range(len(bands))]
    rows = whole.select("part", F.col("region").cast("long").alias("a"), F.lit(None).cast("long").alias("b"), F.col("n").cast("long").alias("n"), *sums)
    edges = pairs.join(whole.select(F.col("region").alias("a"), "part"), "a").select("part", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.lit(None).cast("long").alias("n"), *none)
    n_bands = len(bands)

    def run(part_rows: pd.DataFrame) -> pd.DataFrame:
        regions = _Regions(part_rows, n_bands)
        merge(regions)
        to = [regions.final(r) for r in regions.to]
        return pd.DataFrame({"region": list(regions.to), "merged": to, "n_px": [regions.n[r] for r in to]})

    small = rows.unionByName(edges).join(large, "part", "left_anti").groupBy("part").applyInPandas(lambda x: run(x), "region long, merged long, n_px long")
    if not large.take(1):
        return small
    big = whole.join(large, "part", "left_semi")
    found = in_rounds(big.drop("part"), pairs.join(big.select(F.col("region").alias("a")), "a", "left_semi"))
    size = found.join(big.select("region", "n"), "region").groupBy("merged").agg(F.sum("n").alias("n_px"))
    return small.unionByName(found.join(size, "merged").select(F.col("region").cast("long").alias("region"), F.col("merged").cast("long").alias("merged"), F.col("n_px").cast("long").alias("n_px")))


def merge_in_order(nodes: DataFrame, pairs: DataFrame, bands: Sequence[str], limit: float) -> DataFrame:
    """``region, merged``: the nearest pair of neighbours merges, one after the other, until none is nearer than ``limit``.

    ``nodes`` has ``region, n`` (pixels) and the means ``bands``; ``pairs`` has ``a, b``.  Ties go to the smallest regions; a merged
    region keeps the smaller name.  Connected parts of more than ``LAST_REGIONS`` regions are merged by :func:`merge_mutual_nearest`,
    which may merge other pairs where a merged mean comes nearer to its neighbours.
    """
    return _by_part(nodes, pairs, bands, lambda r: _nearest_first(r, limit), lambda n, p: merge_mutual_nearest(n, p, bands, limit)).select("region", "merged")


def absorb_in_order(nodes: DataFrame, pairs: DataFrame, bands: Sequence[str], least: int) -> DataFrame:
    """``region, merged, resolved``: the smallest region under ``least`` pixels joins its most similar neighbour, one after the other.

    Ties go to the smallest region; a region takes the name of what it joins.  ``resolved`` is false for regions that stay
    under ``least`` because they have no neighbour left.  Connected parts of more than ``LAST_REGIONS`` regions are merged
    by :func:`absorb_small`, all small regions at once.
    """
    found = _by_part(nodes, pairs, bands, lambda r: _smallest_first(r, least), lambda n, p: absorb_small(n, p, bands, least))
    return found.select("region", "merged", (F.col("n_px") >= least).alias("resolved"))


def _near(left: DataFrame, right: DataFrame, metres: float, keys: Sequence[str] = ()) -> DataFrame:
    """``a, b, metres`` for points ``a`` of one table and ``b`` of another (``id, lon, lat``) with equal ``keys`` nearer than a
    distance along the geodesic, by buckets of degrees.

    Buckets are as high as the distance and as wide as it is at the latitude farthest from the equator.  Distances are worked out
    once for each two places, however many points lie there; joins shuffle, so the work is dealt out however small the files are.
    """
    high = metres / 110000.0
    edge = max(t.agg(F.max(F.abs("lat"))).first()[0] or 0.0 for t in (left, right))
    wide = high / max(0.01, math.cos(math.radians(min(89.0, edge + high))))
    key = [F.floor(F.col("lon") / wide).alias("bx"), F.floor(F.col("lat") / high).alias("by")]
    around = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (-1, 0, 1) for y in (-1, 0, 1)))
    place = lambda t, n: t.select(*keys, F.col("lon").alias(f"lon_{n}"), F.col("lat").alias(f"lat_{n}"), *key).distinct()
    p = place(left, "a").withColumn("o", F.explode(around)).withColumn("bx", F.col("bx") + F.col("o.x")).withColumn("by", F.col("by") + F.col("o.y")).drop("o")
    both = p.hint("merge").join(place(right, "b"), [*keys, "bx", "by"]).where((F.abs(F.col("lat_a") - F.col("lat_b")) <= high) & (F.abs(F.col("lon_a") - F.col("lon_b")) <= wide))
    both = both.withColumn("metres", geodesic_m("lon_a", "lat_a", "lon_b", "lat_b")).where(F.col("metres") < metres).drop("bx", "by")
    point = lambda t, n: t.select(*keys, F.col("id").alias(n), F.col("lon").alias(f"lon_{n}"), F.col("lat").alias(f"lat_{n}"))
    found = both.hint("merge").join(point(left, "a"), [*keys, "lon_a", "lat_a"]).select(*keys, "a", "lon_b", "lat_b", "metres")
    return found.hint("merge").join(point(right, "b"), [*keys, "lon_b", "lat_b"]).select("a", "b", "metres")


def near_pairs(points: DataFrame, metres: float, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs of points (``id, lon, lat``) with equal ``keys`` nearer than a distance along the geodesic."""
    return _near(points, points, metres, keys).where("a < b")


#: So many points of a stratum are looked at together; more where its quota is larger.
NEXT_POINTS = 1_000


def spaced_pick(points: DataFrame, stratum: str, order: Sequence, quota: int, metres: float) -> DataFrame:
    """Up to ``quota`` points of each stratum, in order, none nearer to a picked one than ``metres``.

    Each stratum's next points are decided together; strata that still lack some go on with the points that are near none of
    their picks.  Every round picks at least one point of each of these.
    """
    most, left, picked = max(NEXT_POINTS, 2 * quota), points, None
    while True:
        first = table(first_of_groups(left, stratum, order, most).withColumnRenamed("place", "rank"), "first")
        if not first.take(1):
            break
        now = table(independent_prefix(first, near_pairs(first, metres, [stratum]).select("a", "b")).drop("rank"), "spaced")
        picked = now if picked is None else picked.unionByName(now)
        full = picked.groupBy(F.col(stratum).alias("_full")).agg(F.count("*").alias("_n")).where(F.col("_n") >= quota)
        rest = left.join(full.hint("merge"), F.col(stratum).eqNullSafe(F.col("_full")), "left_anti").join(first.select("id").hint("merge"), "id", "left_anti")
        rest = table(rest, "rest")
        if not rest.take(1):
            discard(left, rest, first)
            break
        near = _near(rest, now, metres, [stratum]).select(F.col("a").alias("id")).distinct()
        was, left = left, table(rest.join(near.hint("merge"), "id", "left_anti"), "rest")
        discard(was, rest, first)
    if picked is None:
        return points.withColumn("place", F.lit(1)).limit(0)
    return picked.withColumn("place", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where(F.col("place") <= quota)
