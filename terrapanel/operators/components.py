"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrapanel.sources.shared import discard, table

#: So many edges fit one task.
LAST_EDGES = 500_000


def _join_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the sets of all edges ``n, m``; each set is named by its smallest node."""
    parent, kind = {}, None

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        kind = batch.schema.field(0).type
        for n, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(parent.setdefault(n, n)), root(parent.setdefault(m, m))
            parent[max(x, y)] = min(x, y)
    if parent:
        yield pa.record_batch({"node": pa.array(list(parent), kind), "component": pa.array([root(x) for x in parent], kind)})


def connected_components(edges: DataFrame, a: str, b: str, last_edges: int = 0) -> DataFrame:
    """``node, component`` for every node of an edge; ``component`` is the component's smallest node.

    Rounds of hooking every neighbour to the smallest node around (first larger neighbours, then
    smaller ones) until no edge changes; a chain of n nodes takes about log n rounds.  Each round's
    edges are written to the shared folder, so a lost executor costs one round at most.  Edges with a
    null end and loops are ignored; repeated edges count once.  With no more than ``last_edges`` edges between numbers
    or strings (counted first) one task joins them, with the same result.
    """
    now = table(edges.select(F.greatest(a, b).alias("n"), F.least(a, b).alias("m")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    if last_edges and isinstance(now.schema["n"].dataType, (T.IntegralType, T.StringType)) and now.count() <= last_edges:
        kind = now.schema["n"].dataType.simpleString()
        out = table(now.coalesce(1).mapInArrow(_join_sets, f"node {kind}, component {kind}"), "components")
        discard(now)
        return out
    state = None
    while True:
        both = now.unionByName(now.select(F.col("m").alias("n"), F.col("n").alias("m")))
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"))
        large = both.join(least, "n").where("m > n").select(F.col("m").alias("n"), F.col("least").alias("m")).distinct()
        lower = large.groupBy("n").agg(F.min("m").alias("least"))
        small = large.join(lower, "n").select(F.explode(F.array(F.struct("n", F.col("least").alias("m")), F.struct(F.col("m").alias("n"), F.col("least").alias("m")))).alias("e")).select("e.n", "e.m")
        before, now = now, table(small.where("n <> m").distinct(), "edges")
        discard(before)
        was, state = state, now.agg(F.count("*"), F.sum(F.xxhash64("n", "m").cast("decimal(38,0)"))).first()
        if was == state:
            break
    rooted = now.select(F.col("n").alias("node"), F.col("m").alias("component"))
    out = rooted.unionByName(rooted.select(F.col("component").alias("node"), "component").distinct())
    out.shared_path = now.shared_path
    return out
