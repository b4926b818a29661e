"""Segmentation and merging for many combinations of parameters at once, one result row each.

The combination is part of every key: all images of a sweep are smoothed, segmented, joined to graphs, cut and merged by the same few
jobs, however many combinations there are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapanel.operators.components import connected_components
from terrapanel.operators.graph import region_graph
from terrapanel.operators.percentiles import exact_percentiles
from terrapanel.operators.reviewplan import upsert
from terrapanel.operators.superpixels import superpixels
from terrapanel.sources.shared import table

COMBINATION, MERGE = ("scale", "sigma"), ("scale", "sigma", "percentile")
#: A bell reaches so many deviations.
REACH = 3.0


def smooth(pixels: DataFrame, bands: Sequence[str], keys: Sequence[str], sigma: Column, most: float) -> DataFrame:
    """``keys, px_row, px_col`` and bands as means under a Gaussian bell of deviation ``sigma`` (``most`` is the largest), by rows and then
    by columns; only pixels that are there have weight.  Without deviation nothing changes."""
    reach = math.ceil(REACH * most)
    weight = lambda d: F.when(F.col(d) == 0, 1.0).otherwise(F.exp(-(F.col(d) * F.col(d)) / (2 * sigma * sigma)))
    offsets = F.explode(F.array(*map(F.lit, range(-reach, reach + 1))))
    near = lambda d: F.abs(d) <= REACH * sigma
    across = pixels.select(*keys, "px_row", "px_col", *bands, offsets.alias("d")).where(near("d")).withColumn("w", weight("d"))
    rows = across.groupBy(*keys, "px_row", (F.col("px_col") + F.col("d")).alias("px_col")).agg(F.sum("w").alias("w"), *(F.sum(F.col("w") * F.col(b)).alias(b) for b in bands))
    down = rows.select(*keys, "px_row", "px_col", F.col("w").alias("u"), *bands, offsets.alias("d")).where(near("d")).withColumn("w", weight("d"))
    found = down.groupBy(*keys, (F.col("px_row") + F.col("d")).alias("px_row"), "px_col").agg(F.sum(F.col("w") * F.col("u")).alias("u"), *(F.sum(F.col("w") * F.col(b)).alias(b) for b in bands))
    there = pixels.select(*keys, "px_row", "px_col")
    return there.join(found, [*keys, "px_row", "px_col"]).select(*keys, "px_row", "px_col", *((F.col(b) / F.col("u")).alias(b) for b in bands))


def parameter_sweep(pixels: DataFrame, bands: Sequence[str], scales: Sequence[int], sigmas: Sequence[float], percentiles: Sequence[float], *, rounds: int = 5, compactness: float = 1.0, least: int = 20, done: DataFrame | None = None) -> DataFrame:
    """A row for each combination: ``scale, sigma, percentile, n_segments, n_edges, threshold, n_regions, largest_px, n_small``.

    Images are smoothed by ``sigma`` and cut into segments of about ``scale`` pixels (seeds every root of it, two pixels at least).
    Touching segments nearer than the percentile of all their distances become one region; ``n_small`` counts regions under ``least``
    pixels.  Combinations that ``done`` has with a threshold are not worked out again; its other rows are replaced.
    """
    spark = pixels.sparkSession
    wanted = [(int(s), float(g), float(p)) for s in scales for g in sigmas for p in percentiles]
    if done is not None:
        known = {(r["scale"], r["sigma"], r["percentile"]) for r in done.where("threshold is not null").select(*MERGE).collect()}
        wanted = [w for w in wanted if w not in known]
        if not wanted:
            return done
    cuts = spark.createDataFrame(wanted, "scale int, sigma double, percentile double")
    combos = cuts.select(*COMBINATION).distinct()
    # Smoothing knows no scale: each deviation is worked out once.
    images = table(pixels.crossJoin(F.broadcast(combos.select("sigma").distinct())), "images")
    images = table(smooth(images, bands, ("sigma",), F.col("sigma"), max(w[1] for w in wanted)), "images").join(F.broadcast(combos), "sigma")
    step = F.greatest(F.lit(2), F.floor(F.sqrt(F.col("scale")))).cast("int")
    segments = table(superpixels(images.withColumn("step", step), bands, F.col("step"), rounds, compactness, COMBINATION), "segments")
    nodes, edges = region_graph(segments, "segment", bands, COMBINATION)
    nodes, edges = table(nodes, "nodes"), table(edges, "edges")
    marks = exact_percentiles(edges, "weight", sorted({w[2] for w in wanted}), COMBINATION).select(*COMBINATION, F.col("share").alias("percentile"), F.col("value").alias("threshold"))
    limits = table(cuts.join(marks, list(MERGE), "left"), "limits")
    close = edges.join(F.broadcast(limits), list(COMBINATION)).where("weight < threshold")
    end = lambda c: F.struct(*MERGE, F.col(c).alias("segment")).alias(c)
    found = connected_components(close.select(end("a"), end("b")), "a", "b").select("node.*", F.col("component.segment").alias("region"))
    merged = nodes.join(F.broadcast(limits.select(*MERGE)), list(COMBINATION)).join(found, [*MERGE, "segment"], "left").groupBy(*MERGE, F.coalesce("region", "segment").alias("region")).agg(F.sum("n").alias("n_px"))
    regions = merged.groupBy(*MERGE).agg(F.count("*").alias("n_regions"), F.max("n_px").alias("largest_px"), F.count(F.when(F.col("n_px") < least, 1)).alias("n_small"))
    counted = nodes.groupBy(*COMBINATION).agg(F.count("*").alias("n_segments")).join(edges.groupBy(*COMBINATION).agg(F.count("*").alias("n_edges")), list(COMBINATION), "left").na.fill(0)
    out = regions.join(F.broadcast(counted), list(COMBINATION)).join(F.broadcast(limits), list(MERGE)).select(*MERGE, "n_segments", "n_edges", "threshold", "n_regions", "largest_px", "n_small")
    return out if done is None else upsert(done, out, MERGE)
