"""Exact percentiles of any number of values, without a state that holds them all.

Equal values are counted first, on the map side too.  The counts are dealt out in ranges of group and value; each range adds up its
own, and what lies before a range comes from the ranges' totals.  Then only the two values at a percentile's ranks are
looked up.  No task holds more than a range, also where one group has all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.sources.shared import table


def _ranked(df: DataFrame, value: str, by: Sequence[str], weight: Column) -> tuple[DataFrame, DataFrame]:
    """Each group's values with their weight ``n`` and the weight ``before`` of smaller ones; each group's ``total``."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.sum(weight).alias("n"))
    ranged = table(counts.repartitionByRange(*by, "v").withColumn("part", F.spark_partition_id()), "ranges")
    parts = ranged.groupBy(*by, "part").agg(F.sum("n").alias("n_part"))
    # A row for each group and range: as many as there are ranges and groups, not values.
    ahead = parts.withColumn("ahead", F.sum("n_part").over(Window.partitionBy(*by).orderBy("part")) - F.col("n_part"))
    own = Window.partitionBy(*by, "part").orderBy("v")
    out = ranged.join(ahead.select(*by, "part", "ahead"), [*by, "part"]).withColumn("before", F.col("ahead") + F.sum("n").over(own) - F.col("n"))
    return out.select(*by, "v", "n", "before"), parts.groupBy(*by).agg(F.sum("n_part").alias("total"))


def exact_percentiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by, share, value``: interpolated percentiles (at rank ``share * (n - 1)``) of each group's values; nulls don't count.

    Groups without a value have no rows.
    """
    ranked, totals = _ranked(df, value, by, F.lit(1))
    asked = totals.withColumn("share", F.explode(F.array(*(F.lit(float(s)) for s in shares)))).withColumn("rank", F.col("share") * (F.col("total") - 1))
    asked = asked.select(*by, "share", "rank", F.floor("rank").alias("low"), F.ceil("rank").alias("high"))
    there = lambda r: (F.col("before") <= F.col(r)) & (F.col(r) < F.col("before") + F.col("n"))
    near = ranked.join(asked, list(by)) if by else ranked.crossJoin(F.broadcast(asked))
    ends = near.where(there("low") | there("high")).groupBy(*by, "share", "rank", "low", "high").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    between = F.when(F.col("low") == F.col("high"), F.col("a")).otherwise((F.col("high") - F.col("rank")) * F.col("a") + (F.col("rank") - F.col("low")) * F.col("b"))
    return ends.select(*by, "share", between.alias("value"))


def weighted_percentiles(df: DataFrame, value: str, weight: str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by, share, value``: the smallest value at which ``share`` of the group's weight is reached; rows without weight don't count."""
    ranked, totals = _ranked(df.where(F.col(weight) > 0), value, by, F.col(weight))
    asked = totals.withColumn("share", F.explode(F.array(*(F.lit(float(s)) for s in shares)))).select(*by, "share", (F.col("share") * F.col("total")).alias("goal"))
    near = ranked.join(asked, list(by)) if by else ranked.crossJoin(F.broadcast(asked))
    return near.where(F.col("before") + F.col("n") >= F.col("goal")).groupBy(*by, "share").agg(F.min("v").alias("value"))
