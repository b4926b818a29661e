"""Components, leaks, patches and region graphs on lattices of pixels or cells."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.operators.components import LAST_EDGES, connected_components
from terrapanel.operators.lattice import nearest_valid, neighbours
from terrapanel.operators.percentiles import exact_percentiles
from terrapanel.sources.shared import discard, table

#: Pixels that a hole looks around at first.
REACH = 8
STEPS = {4: ((0, 1), (1, 0)), 8: ((0, 1), (1, 0), (1, 1), (1, -1))}


def same_value_edges(pixels: DataFrame, value: str, connectivity: int = 4, keys: Sequence[str] = ()) -> DataFrame:
    """Edges between neighbouring pixels with equal values; ``pixels`` has ``id, px_row, px_col``."""
    steps = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in STEPS[connectivity]))
    ahead = pixels.select(F.col("id").alias("a"), *keys, value, "px_row", "px_col", F.explode(steps).alias("o")).select("a", *keys, value, (F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col"))
    return ahead.join(pixels.select(F.col("id").alias("b"), *keys, value, "px_row", "px_col"), [*keys, value, "px_row", "px_col"]).select("a", "b")


def patches(pixels: DataFrame, value: str, connectivity: int = 4, keys: Sequence[str] = ()) -> DataFrame:
    """``pixels`` with ``patch``, the smallest id of the connected pixels of the same value.

    Runs along a row collapse first, so the graph that needs rounds has one node for each run.
    """
    row = Window.partitionBy(*keys, value, "px_row").orderBy("px_col")
    runs = pixels.withColumn("island", F.col("px_col") - F.row_number().over(row))
    w = Window.partitionBy(*keys, value, "px_row", "island")
    runs = table(runs.withColumn("run", F.min("id").over(w)).drop("island"), "runs")
    below = ((1, 0),) if connectivity == 4 else ((1, 0), (1, 1), (1, -1))
    steps = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in below))
    ahead = runs.select(F.col("run").alias("a"), *keys, value, "px_row", "px_col", F.explode(steps).alias("o")).select("a", *keys, value, (F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col"))
    edges = ahead.hint("merge").join(runs.select(F.col("run").alias("b"), *keys, value, "px_row", "px_col"), [*keys, value, "px_row", "px_col"]).select("a", "b").distinct()
    found = connected_components(edges, "a", "b", LAST_EDGES).select(F.col("node").alias("run"), "component")
    return runs.join(found.hint("merge"), "run", "left").withColumn("patch", F.coalesce("component", "run")).drop("run", "component")


def patch_table(labelled: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row for each patch: value, pixels, area, bounds."""
    return labelled.groupBy(*keys, "patch", value).agg(F.count("*").alias("n_px"), F.sum("area").alias("ha"), F.min("px_row").alias("row0"), F.max("px_row").alias("row1"), F.min("px_col").alias("col0"), F.max("px_col").alias("col1"))


def size_distribution(patch_rows: DataFrame, by: Sequence[str], small: int) -> DataFrame:
    """Patch sizes of each group: number, hectares, median, 90th percentile, largest, and the share of small patches."""
    return patch_rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum("ha").alias("ha"), F.percentile("n_px", 0.5).alias("p50"), F.percentile("n_px", 0.9).alias("p90"), F.max("n_px").alias("largest"),
        F.round(100.0 * F.avg((F.col("n_px") < small).cast("int")), 4).alias("small_pct"),
    )


def clusters(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Each cell's cluster of eight-neighbours (its smallest cell); ``cells`` has ``cell_id, row_idx, col_idx``."""
    cells = table(cells, "cells")
    found = connected_components(neighbours(cells, keys), "a", "b", LAST_EDGES).select(F.col("node").alias("cell_id"), F.col("component").alias("cluster"))
    return cells.join(found, "cell_id", "left").withColumn("cluster", F.coalesce("cluster", "cell_id"))


def leaks(cells: DataFrame, split: str = "split") -> DataFrame:
    """Directed neighbour pairs, and leaks: neighbours in different splits, each counted once."""
    cells = table(cells, "cells")
    pairs = neighbours(cells)
    named = pairs.join(cells.select(F.col("cell_id").alias("a"), F.col(split).alias("sa")), "a").join(cells.select(F.col("cell_id").alias("b"), F.col(split).alias("sb")), "b")
    return named.agg(F.count("*").alias("neighbor_pairs"), (F.coalesce(F.sum((F.col("sa") != F.col("sb")).cast("int")), F.lit(0)) / 2).cast("long").alias("leaks"))


def repair_leaks(cells: DataFrame, split: str = "split") -> DataFrame:
    """Clusters with more than one split become ``train``: what repeated repair towards train ends in."""
    mixed = Window.partitionBy("cluster")
    many = F.size(F.collect_set(split).over(mixed))
    return clusters(cells).withColumn(split, F.when(many > 1, F.lit("train")).otherwise(F.col(split)))


def sieve(pixels: DataFrame, value: str, least: int, connectivity: int = 8, rounds: int = 50) -> DataFrame:
    """Pixels of patches under ``least`` pixels take the majority of their settled neighbours, all at once, round by round.

    Ties go to the smallest value; only pixels outside small patches, or settled in an earlier round,
    vote.  What no vote reaches within the rounds takes the value of the nearest settled pixel, ties to
    the smallest row, then column; without any settled pixel it keeps its value and has ``resolved`` false.
    """
    labelled = patches(pixels, value, connectivity)
    size = F.count("*").over(Window.partitionBy("patch"))
    state = table(labelled.withColumn("settled", size >= least).select("id", "px_row", "px_col", F.col(value).alias("old"), "settled"), "sieve")
    ring = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1) if r or c))
    # An unsettled pixel is decided as soon as any neighbour is settled; so only pixels settled in the round before vote, and joins
    # shuffle: files of pixels that are small on disk would be large in the driver's memory.
    left, decided = state.where(~F.col("settled")).select("id", "px_row", "px_col"), []
    front = state.where("settled").select("px_row", "px_col", F.col("old").alias("now"))
    for _ in range(rounds):
        votes = front.select("now", F.explode(ring).alias("o"), "px_row", "px_col").select((F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col"), "now")
        won = table(left.hint("merge").join(votes, ["px_row", "px_col"]).groupBy("id", "px_row", "px_col").agg(F.mode("now", True).alias("now")), "votes")
        if not won.take(1):
            discard(won)
            break
        decided.append(won)
        was, left, front = left, table(left.join(won.select("id").hint("merge"), "id", "left_anti"), "left"), won
        discard(was)
    if left.take(1):
        settled = state.where("settled").select("px_row", "px_col", F.col("old").alias("value"))
        for won in decided:
            settled = settled.unionByName(won.select("px_row", "px_col", F.col("now").alias("value")))
        near = nearest_valid(left, settled, REACH).withColumnRenamed("value", "now")
        decided.append(left.join(near.hint("merge"), ["px_row", "px_col"]))
    if not decided:
        return state.select("id", "px_row", "px_col", "old", F.col("old").alias("new"), F.col("settled").alias("resolved"))
    found = reduce(DataFrame.unionByName, (d.select("id", "now") for d in decided))
    state = state.join(found.hint("merge"), "id", "left").withColumn("settled", F.col("settled") | F.col("now").isNotNull()).withColumn("now", F.coalesce("now", "old"))
    return state.select("id", "px_row", "px_col", "old", F.col("now").alias("new"), F.col("settled").alias("resolved"))


def sieve_into_largest(pixels: DataFrame, value: str, least: int, connectivity: int = 4) -> DataFrame:
    """Patches under ``least`` pixels take the value of their largest neighbour, ties to the smallest patch."""
    labelled = table(patches(pixels, value, connectivity).select("id", "px_row", "px_col", value, "patch"), "patches")
    size = labelled.groupBy("patch").agg(F.count("*").alias("n"), F.first(value).alias("v"))
    ahead = labelled.withColumn("o", F.explode(F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 1), (1, 0), (0, -1), (-1, 0))))))
    ahead = ahead.select(F.col("patch").alias("p"), (F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col"))
    touch = ahead.join(labelled.select("px_row", "px_col", F.col("patch").alias("q")), ["px_row", "px_col"]).where("p <> q").select("p", "q").distinct()
    small = size.where(F.col("n") < least).select(F.col("patch").alias("p"))
    best = touch.join(small, "p").join(size.select(F.col("patch").alias("q"), "n", "v"), "q").groupBy("p").agg(F.min_by("v", F.struct(-F.col("n"), F.col("q"))).alias("new"))
    return labelled.join(best.withColumnRenamed("p", "patch"), "patch", "left").select("id", F.col(value).alias("old"), F.coalesce("new", value).alias("new"))


def region_graph(pixels: DataFrame, region: str, bands: Sequence[str], keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Regions with their mean bands, and edges between touching regions weighted by the distance of the means; within equal ``keys``."""
    nodes = pixels.groupBy(*keys, region).agg(F.count("*").alias("n"), *(F.avg(b).alias(b) for b in bands))
    step = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in STEPS[4]))
    ahead = pixels.select(*keys, F.col(region).alias("p"), F.explode(step).alias("o"), "px_row", "px_col").select(*keys, "p", (F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col"))
    pairs = ahead.join(pixels.select(*keys, "px_row", "px_col", F.col(region).alias("q")), [*keys, "px_row", "px_col"]).where("p <> q").select(*keys, F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    left, right = nodes.select(*keys, F.col(region).alias("a"), *(F.col(b).alias(f"a_{b}") for b in bands)), nodes.select(*keys, F.col(region).alias("b"), *(F.col(b).alias(f"b_{b}") for b in bands))
    d = sum((F.pow(F.col(f"a_{b}") - F.col(f"b_{b}"), 2) for b in bands), F.lit(0.0))
    return nodes, pairs.join(left, [*keys, "a"]).join(right, [*keys, "b"]).select(*keys, "a", "b", F.sqrt(d).alias("weight"))


def cut_and_merge(nodes: DataFrame, edges: DataFrame, region: str, percentile: float) -> DataFrame:
    """Regions joined by edges under a percentile of the weights become one (their smallest region)."""
    limit = exact_percentiles(edges, "weight", [percentile]).select(F.col("value").alias("limit"))
    close = edges.crossJoin(F.broadcast(limit)).where("weight < limit")
    found = connected_components(close, "a", "b", LAST_EDGES).select(F.col("node").alias(region), F.col("component").alias("merged"))
    return nodes.select(region).join(found, region, "left").withColumn("merged", F.coalesce("merged", region))
