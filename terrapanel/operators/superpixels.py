"""Superpixels: k-means in colour and position around a grid of seeds, each pixel looking at near seeds only, then one
connected part for each segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.operators.graph import STEPS, patches
from terrapanel.sources.shared import discard, table


def _square(x: Column) -> Column:
    return x * x


def assign_to_seeds(pixels: DataFrame, bands: Sequence[str], step: int | Column, rounds: int = 5, compactness: float = 1.0, keys: Sequence[str] = ()) -> DataFrame:
    """``pixels`` (``keys``, ``px_row, px_col`` and bands) with ``seed``, a struct of the seed's square; each key is an image of its own.

    A seed stands in every ``step`` x ``step`` square of the lattice (a number, or a column of the keys).  In a round each pixel takes the
    nearest of the seeds of its own square and the eight around (colour distance squared plus
    ``compactness`` times the distance in steps squared; ties to the smallest square), then the seeds move
    to their pixels' means.  A pixel looks at nine seeds a round whatever their number; each round's
    seeds are written to the shared folder.
    """
    step = step if isinstance(step, Column) else F.lit(step)
    home = pixels.withColumn("bin_r", F.floor(F.col("px_row") / step).cast("int")).withColumn("bin_c", F.floor(F.col("px_col") / step).cast("int"))
    means = [F.avg(b).alias(f"s_{b}") for b in bands]
    place = [F.avg("px_row").alias("s_row"), F.avg("px_col").alias("s_col")]
    seeds = table(home.groupBy(*keys, F.struct("bin_r", "bin_c").alias("seed")).agg(*place, *means), "seeds")
    ring = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1)))
    distance = lambda x: sum((_square(F.col(b) - x[f"s_{b}"]) for b in bands), F.lit(0.0)) + compactness * (_square(F.col("px_row") - x["s_row"]) + _square(F.col("px_col") - x["s_col"])) / (step * step)
    nearest = F.array_min(F.transform("near", lambda x: F.struct(distance(x).alias("d"), x["seed"].alias("seed"))))["seed"]
    best = None
    for _ in range(rounds):
        # A seed keeps its square, so that what looks at it stays the same.
        spread = seeds.withColumn("o", F.explode(ring)).withColumn("bin_r", F.col("seed.bin_r") + F.col("o.r")).withColumn("bin_c", F.col("seed.bin_c") + F.col("o.c")).drop("o")
        # A square's seeds come as one array: a pixel stays one row.
        around = spread.groupBy(*keys, "bin_r", "bin_c").agg(F.collect_list(F.struct("seed", "s_row", "s_col", *(f"s_{b}" for b in bands))).alias("near"))
        near = home.join(around.hint("merge"), [*keys, "bin_r", "bin_c"])
        now = table(near.select(*keys, "px_row", "px_col", *bands, nearest.alias("seed")), "superpixels")
        moved = table(now.groupBy(*keys, "seed").agg(*place, *means), "seeds")
        discard(seeds, *([best] if best is not None else []))
        best, seeds = now, moved
    discard(seeds)
    return best


def borders(labelled: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, p, q, n``: how many pixel edges two labels share, both ways round."""
    steps = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in STEPS[4]))
    ahead = labelled.select(*keys, F.col(label).alias("p"), "px_row", "px_col", F.explode(steps).alias("o")).select(*keys, "p", (F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col"))
    half = ahead.hint("merge").join(labelled.select(*keys, "px_row", "px_col", F.col(label).alias("q")), [*keys, "px_row", "px_col"]).where("p <> q").groupBy(*keys, "p", "q").agg(F.count("*").alias("n"))
    return half.unionByName(half.select(*keys, F.col("q").alias("p"), F.col("p").alias("q"), "n")).groupBy(*keys, "p", "q").agg(F.sum("n").alias("n"))


def connect_segments(labelled: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """``labelled`` (``keys, px_row, px_col`` and ``value``) with ``segment`` in place of ``value``: one connected part each.

    The largest part of a value (ties to the smallest) is the segment and gives it its name, the smallest pixel as
    ``row * 2^32 + column``.  The other parts join, round by round from the segments outwards, the segment with which they share the
    longest border (ties to the smallest).  Parts that touch nothing are segments of their own.  Only parts and
    their borders take part in the rounds, not pixels.
    """
    pixels = labelled.withColumn("place", F.col("px_row").cast("long") * (1 << 32) + F.col("px_col")).withColumn("id", F.struct(*keys, "place") if keys else F.col("place"))
    found = table(patches(pixels, value, 4, keys).withColumn("patch", F.col("patch.place") if keys else F.col("patch")), "parts")
    sizes = found.groupBy(*keys, value, "patch").agg(F.count("*").alias("n"))
    first = F.row_number().over(Window.partitionBy(*keys, value).orderBy(F.desc("n"), "patch")) == 1
    owners = table(sizes.select(*keys, "patch", F.when(first, F.col("patch")).alias("owner")), "owners")
    touch = table(borders(found, "patch", keys), "borders")
    while True:
        settled = owners.where("owner is not null").select(*keys, F.col("patch").alias("q"), "owner")
        open_ = owners.where("owner is null").select(*keys, F.col("patch").alias("p"))
        shared = touch.hint("merge").join(open_, [*keys, "p"]).join(settled.hint("merge"), [*keys, "q"]).groupBy(*keys, "p", "owner").agg(F.sum("n").alias("n"))
        won = table(shared.groupBy(*keys, "p").agg(F.min_by("owner", F.struct(-F.col("n"), F.col("owner"))).alias("to")), "won")
        if not won.take(1):
            break
        new = table(owners.join(won.withColumnRenamed("p", "patch").hint("merge"), [*keys, "patch"], "left").select(*keys, "patch", F.coalesce("owner", "to").alias("owner")), "owners")
        discard(owners, won)
        owners = new
    return found.join(owners.select(*keys, "patch", F.coalesce("owner", "patch").alias("segment")).hint("merge"), [*keys, "patch"]).drop("patch", "id", "place", value)


def superpixels(pixels: DataFrame, bands: Sequence[str], step: int | Column, rounds: int = 5, compactness: float = 1.0, keys: Sequence[str] = ()) -> DataFrame:
    """``pixels`` with ``segment``: k-means around seeds, then one connected part for each segment."""
    return connect_segments(assign_to_seeds(pixels, bands, step, rounds, compactness, keys), "seed", keys)
