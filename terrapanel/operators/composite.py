"""Composites of repeated observations by pixel: masks, seasonal medians, quality mosaics, focal statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ("px_row", "px_col")
#: Percentiles are interpolated; an observation so near to one counts as at it.
NEAR = 1e-9


def seasonal(obs: DataFrame, keys: Sequence[str], index: str, bands: Sequence[str]) -> DataFrame:
    """Median of all, of the dry (index up to its 25th percentile) and of the wet observations (from the 75th), least, most, spread, deviation."""
    marks = obs.groupBy(*keys).agg(F.percentile(index, F.array(F.lit(0.25), F.lit(0.75))).alias("p"))
    both = obs.join(marks, list(keys))
    aggs = []
    for b in bands:
        dry, wet = F.when(F.col(index) <= F.col("p")[0] + NEAR, F.col(b)), F.when(F.col(index) >= F.col("p")[1] - NEAR, F.col(b))
        aggs += [F.median(b).alias(f"{b}_median"), F.median(dry).alias(f"{b}_dry"), F.median(wet).alias(f"{b}_wet"), F.min(b).alias(f"{b}_min"), F.max(b).alias(f"{b}_max"), (F.max(b) - F.min(b)).alias(f"{b}_amp"), F.stddev_pop(b).alias(f"{b}_std")]
    out = both.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *(F.round(c, 4).alias(c) for c in out.columns if c not in keys))


def quality_mosaic(obs: DataFrame, keys: Sequence[str], index: str, bands: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """All bands of the observation with the highest index; ties go to the smallest ``tie``."""
    first = F.min_by(F.struct(*bands), F.struct((-F.col(index)).alias("i"), *tie))
    return obs.where(F.col(index).isNotNull()).groupBy(*keys).agg(first.alias("b")).select(*keys, "b.*")


def extremes(obs: DataFrame, keys: Sequence[str], index: str, bands: Sequence[str], percentiles: Sequence[int] = (1, 99), slices: Sequence[int] = (25, 75)) -> DataFrame:
    """Of each band the median, two outer percentiles, least and most, and the medians of the observations whose index is up to the
    first and from the second percentile of ``slices``: ``b_median, b_p1, b_p99, b_min, b_max, b_median_p25, b_median_p75``."""
    marks = obs.groupBy(*keys).agg(F.percentile(index, F.array(*(F.lit(p / 100) for p in slices))).alias("p"))
    low, high = F.col(index) <= F.col("p")[0] + NEAR, F.col(index) >= F.col("p")[1] - NEAR
    aggs = []
    for b in bands:
        aggs += [F.median(b).alias(f"{b}_median"), *(F.percentile(b, p / 100).alias(f"{b}_p{p}") for p in percentiles), F.min(b).alias(f"{b}_min"), F.max(b).alias(f"{b}_max")]
        aggs += [F.median(F.when(part, F.col(b))).alias(f"{b}_median_p{p}") for p, part in zip(slices, (low, high), strict=True)]
    out = obs.join(marks, list(keys)).groupBy(*keys).agg(*aggs)
    return out.select(*keys, *(F.round(c, 4).alias(c) for c in out.columns if c not in keys))


def focal_mean(pixels: DataFrame, value: str, reach: int, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over the square of ``reach`` pixels around each pixel, by rows and then by columns; missing pixels don't count."""
    across = Window.partitionBy(*keys, "px_row").orderBy("px_col").rangeBetween(-reach, reach)
    down = Window.partitionBy(*keys, "px_col").orderBy("px_row").rangeBetween(-reach, reach)
    part = pixels.withColumn("s", F.sum(value).over(across)).withColumn("n", F.count(value).over(across))
    full = part.withColumn("fs", F.sum("s").over(down)).withColumn("fn", F.sum("n").over(down))
    return full.withColumn("focal", F.col("fs") / F.col("fn")).drop("s", "n", "fs", "fn")


def focal_entropy(pixels: DataFrame, value: str, reach: int) -> DataFrame:
    """Entropy (bits) of the values in the square around each pixel."""
    ring = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in range(-reach, reach + 1) for c in range(-reach, reach + 1)))
    seen = pixels.select(value, F.explode(ring).alias("o"), "px_row", "px_col").select(value, (F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col"))
    counts = seen.join(pixels.select("px_row", "px_col"), ["px_row", "px_col"]).groupBy("px_row", "px_col", value).agg(F.count("*").alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy("px_row", "px_col"))
    return counts.withColumn("p", p).groupBy("px_row", "px_col").agg((-F.sum(F.col("p") * F.log2("p")) + 0.0).alias("entropy"))


def slope_aspect(pixels: DataFrame, value: str, size: float) -> DataFrame:
    """Slope and aspect in degrees from the 3 x 3 neighbourhood (Horn's weights), for pixels with all neighbours; flat ones have no aspect."""
    ring = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1)))
    near = pixels.select(F.col("px_row").alias("r0"), F.col("px_col").alias("c0"), value, F.explode(ring).alias("o")).select((F.col("r0") - F.col("o.r")).alias("px_row"), (F.col("c0") - F.col("o.c")).alias("px_col"), "o.r", "o.c", value)
    wx, wy = F.col("c") * F.when(F.col("r") == 0, 2).otherwise(1), F.col("r") * F.when(F.col("c") == 0, 2).otherwise(1)
    g = near.groupBy("px_row", "px_col").agg(F.count("*").alias("n"), (F.sum(wx * F.col(value)) / (8 * size)).alias("dx"), (F.sum(wy * F.col(value)) / (8 * size)).alias("dy"))
    full = g.where("n = 9").join(pixels.select("px_row", "px_col"), ["px_row", "px_col"])
    return full.select("px_row", "px_col", F.round(F.degrees(F.atan(F.sqrt(F.pow("dx", 2) + F.pow("dy", 2)))), 4).alias("slope"), F.when((F.col("dx") != 0) | (F.col("dy") != 0), F.round(F.pmod(F.degrees(F.atan2(F.col("dx"), -F.col("dy"))) + 360, F.lit(360.0)), 4)).alias("aspect"))
