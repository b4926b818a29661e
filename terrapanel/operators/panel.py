"""Aggregates of a pixel panel ``px_row, px_col, grid_id, area, year, class_id`` by pixel, block and cell.

All are plain aggregations and windows over the long table: the heavy ones group by pixel or by
(cell, class), and Spark combines on the map side.  Ties of a mode go to the smallest class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.sources.shared import table

PIXEL = ("px_row", "px_col", "grid_id", "area")
NO_DATA, UNOBSERVED = 0, 8


def temporal_mode(panel: DataFrame, exclude: Sequence[int] = (), by: Sequence[str] = PIXEL) -> DataFrame:
    """The most frequent class of each pixel; excluded classes don't count, and 0 is given if none is left."""
    value = F.when(~F.col("class_id").isin(*exclude), F.col("class_id")) if exclude else F.col("class_id")
    return panel.groupBy(*by).agg(F.coalesce(F.mode(value, True), F.lit(NO_DATA)).alias("mode_id"))


def block_mode(panel: DataFrame, factor: int, exclude: Sequence[int] = ()) -> DataFrame:
    """Mode of each ``factor`` x ``factor`` block and year; blocks cut off by the panel's last row or column are left out."""
    extent = panel.agg(F.expr(f"(max(px_row) + 1) DIV {factor}").alias("n_rows"), F.expr(f"(max(px_col) + 1) DIV {factor}").alias("n_cols"))
    whole = panel.crossJoin(F.broadcast(extent)).where(f"px_row DIV {factor} < n_rows AND px_col DIV {factor} < n_cols").drop("n_rows", "n_cols")
    blocks = whole.withColumn("block_row", F.expr(f"px_row DIV {factor}").cast("int")).withColumn("block_col", F.expr(f"px_col DIV {factor}").cast("int"))
    return temporal_mode(blocks, exclude, ("block_row", "block_col", "year"))


def block_validity(panel: DataFrame, factor: int, least: float = 0.5) -> DataFrame:
    """Whether at least half of a block's pixels are valid in a year."""
    valid = (~F.col("class_id").isin(NO_DATA, UNOBSERVED)).cast("int")
    return panel.groupBy(F.expr(f"px_row DIV {factor}").cast("int").alias("block_row"), F.expr(f"px_col DIV {factor}").cast("int").alias("block_col"), "year").agg((F.avg(valid) >= least).alias("valid"))


def area_by_class(modes: DataFrame) -> DataFrame:
    """Hectares of each class in each cell."""
    return modes.groupBy("grid_id", F.col("mode_id").alias("class_id")).agg(F.sum("area").alias("ha"))


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(F.lit(100.0) * part, whole), 4)


def composition(modes: DataFrame, groups: dict[str, Sequence[int]], weight: str = "area") -> DataFrame:
    """Total, no-data, unobserved and valid area of each cell, and shares of class groups in the valid area."""
    w, c = F.col(weight), F.col("mode_id")
    out = modes.groupBy("grid_id").agg(
        F.sum(w).alias("total"),
        F.sum(F.when(c == NO_DATA, w).otherwise(0)).alias("nodata"),
        F.sum(F.when(c == UNOBSERVED, w).otherwise(0)).alias("unobserved"),
        *(F.sum(F.when(c.isin(*ids), w).otherwise(0)).alias(f"area_{name}") for name, ids in groups.items()),
    )
    out = out.withColumn("valid", F.col("total") - F.col("nodata") - F.col("unobserved"))
    return out.select(
        "grid_id", "total", "valid", _share(F.col("valid"), F.col("total")).alias("valid_pct"), _share(F.col("nodata"), F.col("total")).alias("nodata_pct"),
        _share(F.col("unobserved"), F.col("total")).alias("unobserved_pct"), *(F.coalesce(_share(F.col(f"area_{n}"), F.col("valid")), F.lit(0.0)).alias(f"{n}_pct") for n in groups),
    )


def class_shares(modes: DataFrame) -> DataFrame:
    """Hectares and share of the valid area for each valid class of a cell."""
    by_class = area_by_class(modes).where(~F.col("class_id").isin(NO_DATA, UNOBSERVED))
    return by_class.withColumn("pct", _share(F.col("ha"), F.sum("ha").over(Window.partitionBy("grid_id"))))


def share_checks(shares: DataFrame, forbidden: Sequence[int]) -> DataFrame:
    """Whether a cell's shares add up to 100 and no forbidden class is there."""
    return shares.groupBy("grid_id").agg(F.sum("pct").between(99.9, 100.1).alias("sums_to_100"), (F.count(F.when(F.col("class_id").isin(*forbidden), 1)) == 0).alias("classes_allowed"))


def period_modes(panel: DataFrame, periods: DataFrame, exclude: Sequence[int] = (), by: Sequence[str] = PIXEL) -> DataFrame:
    """Mode of each pixel in each period; periods are few and sent to every task."""
    inside = panel.join(F.broadcast(periods), F.col("year").between(F.col("y0"), F.col("y1")))
    return temporal_mode(inside, exclude, (*by, "period"))


def best_period_share(panel: DataFrame, modes: DataFrame, periods: DataFrame) -> DataFrame:
    """For each class the largest share it has in a cell under the mode of any period, over pixels valid under the global mode."""
    valid = modes.where(~F.col("mode_id").isin(NO_DATA, UNOBSERVED)).select("px_row", "px_col")
    in_period = period_modes(panel, periods).join(valid, ["px_row", "px_col"])
    by_class = in_period.groupBy("grid_id", "period", F.col("mode_id").alias("class_id")).agg(F.sum("area").alias("ha"))
    whole = F.sum("ha").over(Window.partitionBy("grid_id", "period"))
    return by_class.withColumn("pct", _share(F.col("ha"), whole)).where(~F.col("class_id").isin(NO_DATA, UNOBSERVED)).groupBy("grid_id", "class_id").agg(F.max("pct").alias("pctp"))


def dominant(by_class: DataFrame, key: str = "class_id") -> DataFrame:
    """The class with the largest area of each cell, ties to the smallest id, its share, and the number of classes."""
    top = Window.partitionBy("grid_id").orderBy(F.desc("ha"), key)
    every = Window.partitionBy("grid_id")
    ranked = by_class.select("grid_id", key, "ha", F.row_number().over(top).alias("rank"), F.sum("ha").over(every).alias("whole"), F.count("*").over(every).alias("n_classes"))
    return ranked.where("rank = 1").select("grid_id", F.col(key).alias(f"dominant_{key}"), _share(F.col("ha"), F.col("whole")).alias("dominant_pct"), "n_classes")


def diversity(by_class: DataFrame) -> DataFrame:
    """Shannon index (natural logarithm) of the area shares, and the index over its maximum."""
    p = F.col("ha") / F.sum("ha").over(Window.partitionBy("grid_id"))
    parts = by_class.where("ha > 0").select("grid_id", p.alias("p"))
    out = parts.groupBy("grid_id").agg((-F.sum(F.col("p") * F.log("p"))).alias("h"), F.count("*").alias("n"))
    return out.select("grid_id", F.round(F.col("h") + 0.0, 4).alias("shannon"), F.round(F.when(F.col("n") > 1, F.col("h") / F.log("n")).otherwise(0.0) + 0.0, 4).alias("evenness"))


def zone_shares(modes: DataFrame, zones: DataFrame) -> DataFrame:
    """Dominant zone of each cell and its share of the area that has a zone."""
    inside = modes.join(zones.where("eco_id > 0"), ["px_row", "px_col"])
    return dominant(inside.groupBy("grid_id", "eco_id").agg(F.sum("area").alias("ha")), "eco_id")


def confusion_risk(modes: DataFrame, zones: DataFrame, pairs: DataFrame) -> DataFrame:
    """Share of the zoned area whose class is confusable with the cell's dominant class (``dominant, other``)."""
    inside = modes.join(zones.where("eco_id > 0"), ["px_row", "px_col"])
    by_class = inside.groupBy("grid_id", F.col("mode_id").alias("class_id")).agg(F.sum("area").alias("ha"))
    top = dominant(by_class.where(~F.col("class_id").isin(NO_DATA, UNOBSERVED))).select("grid_id", "dominant_class_id")
    risky = by_class.join(top, "grid_id").join(F.broadcast(pairs), (F.col("dominant_class_id") == F.col("dominant")) & (F.col("class_id") == F.col("other")), "left")
    return risky.groupBy("grid_id").agg(_share(F.sum(F.when(F.col("other").isNotNull(), F.col("ha")).otherwise(0)), F.sum("ha")).alias("risk_pct"))


def transitions(panel: DataFrame) -> DataFrame:
    """Mean over a cell's pixels of the share of consecutive valid years between which the class changes."""
    valid = panel.where(~F.col("class_id").isin(NO_DATA, UNOBSERVED))
    w = Window.partitionBy("px_row", "px_col").orderBy("year")
    steps = valid.select("grid_id", "px_row", "px_col", F.when(F.col("year") - F.lag("year").over(w) == 1, (F.col("class_id") != F.lag("class_id").over(w)).cast("int")).alias("changed"))
    by_pixel = steps.groupBy("grid_id", "px_row", "px_col").agg(F.avg("changed").alias("rate"))
    return by_pixel.groupBy("grid_id").agg(F.round(100 * F.avg(F.coalesce("rate", F.lit(0.0))), 4).alias("transition_pct"))


def stable_years(panel: DataFrame, modes: DataFrame, least: float = 0.8) -> DataFrame:
    """Share of a cell's pixels that equal their mode in a year, and whether it is at least ``least``."""
    return year_shares(panel.join(modes.select("px_row", "px_col", "mode_id"), ["px_row", "px_col"]), least)


def year_shares(both: DataFrame, least: float) -> DataFrame:
    """As :func:`stable_years`, of pixels with their modes."""
    out = both.groupBy("grid_id", "year").agg(F.avg((F.col("class_id") == F.col("mode_id")).cast("double")).alias("share"))
    return out.select("grid_id", "year", F.round("share", 4).alias("share"), (F.col("share") >= least).alias("stable"))


def longest_run(years: DataFrame) -> DataFrame:
    """The first of the longest runs of stable years of each cell; nulls if no year is stable."""
    w = Window.partitionBy("grid_id").orderBy("year")
    runs = years.where("stable").withColumn("island", F.col("year") - F.row_number().over(w)).groupBy("grid_id", "island").agg(F.count("*").alias("n"), F.min("year").alias("y0"), F.max("year").alias("y1"))
    best = Window.partitionBy("grid_id").orderBy(F.desc("n"), "y0")
    first = runs.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("grid_id", F.col("n").alias("max_run"), F.col("y0").alias("run_start"), F.col("y1").alias("run_end"))
    return years.select("grid_id").distinct().join(first, "grid_id", "left").withColumn("max_run", F.coalesce("max_run", F.lit(0)))


def period_summary(panel: DataFrame, periods: DataFrame, years: DataFrame) -> DataFrame:
    """Of each cell and period: dominant class under the period's mode, its share, and the number of stable years."""
    by_class = period_modes(panel, periods, (NO_DATA, UNOBSERVED)).where(F.col("mode_id") != NO_DATA).groupBy("grid_id", "period", F.col("mode_id").alias("class_id")).agg(F.sum("area").alias("ha"))
    w = Window.partitionBy("grid_id", "period")
    top = by_class.select("grid_id", "period", "class_id", _share(F.col("ha"), F.sum("ha").over(w)).alias("md_pct"), F.row_number().over(w.orderBy(F.desc("ha"), "class_id")).alias("rank")).where("rank = 1")
    stable = years.where("stable").join(F.broadcast(periods), F.col("year").between(F.col("y0"), F.col("y1"))).groupBy("grid_id", "period").agg(F.count("*").alias("n_stable"))
    return top.join(stable, ["grid_id", "period"], "left").select("grid_id", "period", F.col("class_id").alias("md_id"), "md_pct", F.coalesce("n_stable", F.lit(0)).alias("n_stable"))


def ever_present(panel: DataFrame, groups: dict[str, Sequence[int]]) -> DataFrame:
    """Share of a cell's area whose pixels ever had a class of the group."""
    flags = panel.groupBy(*PIXEL).agg(*(F.max(F.col("class_id").isin(*ids).cast("int")).alias(n) for n, ids in groups.items()))
    return flags.groupBy("grid_id").agg(*(_share(F.sum(F.col(n) * F.col("area")), F.sum("area")).alias(f"{n}_ever_pct") for n in groups))


def remap(panel: DataFrame, legend: DataFrame, default: int) -> DataFrame:
    """Classes through a small legend ``class_id, new_id``; classes without an entry become ``default``."""
    return panel.join(F.broadcast(legend), "class_id", "left").withColumn("new_id", F.coalesce("new_id", F.lit(default)))


def dominant_tile(boxes: DataFrame, tiles: DataFrame) -> DataFrame:
    """The tile with the largest intersection with each box and its share; both have integer bounds and a lattice key ``bucket``."""
    area = (F.least("x1", "tx1") - F.greatest("x0", "tx0")) * (F.least("y1", "ty1") - F.greatest("y0", "ty0"))
    both = boxes.join(tiles, "bucket").where("x0 < tx1 and tx0 < x1 and y0 < ty1 and ty0 < y1").select("box_id", "tile_id", area.alias("shared"), ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("whole"))
    both = both.distinct()
    top = Window.partitionBy("box_id").orderBy(F.desc("shared"), "tile_id")
    return both.withColumn("rank", F.row_number().over(top)).where("rank = 1").select("box_id", "tile_id", _share(F.col("shared"), F.col("whole")).alias("tile_pct"))


def rule_type(cells: DataFrame) -> DataFrame:
    """Priority score, and the temporal and spatial type of a cell by rules on its metrics."""
    temporal = F.when(F.col("transition_pct") >= 60, "transition").when(F.col("max_run") >= 3, "stable").otherwise("annual")
    spatial = F.when(F.col("dominant_pct") >= 60, "homogeneous").when(F.col("n_classes") <= 5, "simple").otherwise("complex")
    priority = F.col("transition_pct") * 0.4 + F.col("shannon") * 20 + F.col("max_run") * 2 + F.col("dominant_pct") * 0.1
    return cells.select("grid_id", temporal.alias("dim_temporal"), spatial.alias("dim_spatial"), F.round(priority, 3).alias("priority"))


def pixel_history(panel: DataFrame) -> DataFrame:
    """Each pixel once: its ``years`` (year, class), its mode, its mode among valid classes, and the rate of changes
    between consecutive valid years (null without any valid year)."""
    found = panel.groupBy(*PIXEL).agg(F.array_sort(F.collect_list(F.struct("year", "class_id"))).alias("years"))
    found = found.withColumn("known", F.filter("years", lambda y: ~y["class_id"].isin(NO_DATA, UNOBSERVED)))

    def mode(years: str) -> Column:
        classes = F.transform(years, lambda y: y["class_id"])
        counts = F.transform(F.array_distinct(classes), lambda c: F.struct(F.size(F.filter(classes, lambda x: x == c)).alias("n"), (-c).alias("less")))
        return F.coalesce(-F.array_max(counts)["less"], F.lit(NO_DATA))

    less = F.greatest(F.size("known") - 1, F.lit(0))
    steps = F.zip_with(F.slice("known", 1, less), F.slice("known", 2, less), lambda a, b: F.when(b["year"] - a["year"] == 1, (a["class_id"] != b["class_id"]).cast("int")))
    steps = F.filter(steps, lambda x: x.isNotNull())
    rate = F.coalesce(F.try_divide(F.aggregate(steps, F.lit(0), lambda a, x: a + x).cast("double"), F.size(steps)), F.lit(0.0))
    return found.select(*PIXEL, "years", mode("years").alias("mode_id"), mode("known").alias("valid_mode_id"), F.when(F.size("known") > 0, rate).alias("rate"))


def characterise(panel: DataFrame, zones: DataFrame) -> DataFrame:
    """One row for each cell: composition, dominant class, diversity, zone, transitions and longest stable run.

    The panel is read once, into one row for each pixel, which is written and from which all parts come.
    """
    history = table(pixel_history(panel), "history")
    modes = history.select(*PIXEL, "mode_id")
    by_class = class_shares(modes).select("grid_id", "class_id", "ha")
    long = history.select(*PIXEL, F.col("valid_mode_id").alias("mode_id"), F.explode("years").alias("y")).select("grid_id", "y.year", "y.class_id", "mode_id")
    changes = history.where("rate is not null").groupBy("grid_id").agg(F.round(100 * F.avg("rate"), 4).alias("transition_pct"))
    parts = [dominant(by_class), diversity(by_class), zone_shares(modes, zones).select("grid_id", "dominant_eco_id"), changes, longest_run(year_shares(long, 0.4))]
    out = composition(modes, {})
    for part in parts:
        out = out.join(part, "grid_id", "left")
    return out


def masked_metrics(panel: DataFrame, zones: DataFrame, mask: DataFrame, pairs: DataFrame, last_year: int) -> DataFrame:
    """One row for each cell with pixels in the mask, every pixel counting the same.

    ``zones`` has ``px_row, px_col, eco_id`` (0: none), ``mask`` the places that count, ``pairs`` the classes (``dominant, other``) that are
    easily confused.  Shares of no data, unobserved and valid pixels are of all pixels in the mask; the modal class, the class of
    ``last_year``, the number of classes and their diversity are of the valid ones; the zone and the share of classes that are confused with the modal
    one are of those that have a zone too.  A cell without valid pixels has only the first three shares; without any in a zone its zone is 0.
    Ties go to the smallest class or zone.
    """
    pixel = ["px_row", "px_col", "grid_id"]
    history = panel.join(mask.select("px_row", "px_col").distinct(), ["px_row", "px_col"], "left_semi").groupBy(*pixel).agg(F.mode("class_id", True).alias("class_id"), F.max(F.when(F.col("year") == last_year, F.col("class_id"))).alias("last_id"))
    px = table(history.join(zones, ["px_row", "px_col"], "left").withColumn("valid", ~F.col("class_id").isin(NO_DATA, UNOBSERVED)).withColumn("zoned", F.col("valid") & (F.coalesce("eco_id", F.lit(0)) > 0)), "masked")
    n = lambda c: F.count(F.when(c, 1))
    cells = px.groupBy("grid_id").agg(F.count("*").alias("n"), n(F.col("class_id") == NO_DATA).alias("n_nodata"), n(F.col("class_id") == UNOBSERVED).alias("n_unobserved"), n(F.col("valid")).alias("n_valid"), n(F.col("zoned")).alias("n_zoned"))

    def largest(rows: DataFrame, key: str, name: str) -> DataFrame:
        counts = rows.where(F.col(key).isNotNull()).groupBy("grid_id", key).agg(F.count("*").alias("k"))
        return counts.groupBy("grid_id").agg(F.max_by(F.struct(F.col(key).alias("id"), "k"), F.struct("k", -F.col(key))).alias(name))

    by_class = px.where("valid").groupBy("grid_id", "class_id").agg(F.count("*").alias("k"), n(F.col("zoned")).alias("k_zoned"))
    p = F.col("k") / F.sum("k").over(Window.partitionBy("grid_id"))
    modes = by_class.withColumn("p", p).groupBy("grid_id").agg(F.max_by(F.struct(F.col("class_id").alias("id"), "k"), F.struct("k", -F.col("class_id"))).alias("mode"), F.count("*").alias("n_mode_classes"), (-F.sum(F.col("p") * F.log("p")) + 0.0).alias("shannon"))
    risk = by_class.join(modes.select("grid_id", F.col("mode.id").alias("dominant")), "grid_id").join(F.broadcast(pairs.withColumnRenamed("other", "class_id")), ["dominant", "class_id"], "left_semi").groupBy("grid_id").agg(F.sum("k_zoned").alias("k_risk"))
    out = cells
    for part in (modes, largest(px.where("valid"), "last_id", "last"), largest(px.where("zoned"), "eco_id", "eco"), risk):
        out = out.join(part, "grid_id", "left")
    any_, zoned = F.col("n_valid") > 0, F.col("n_zoned") > 0
    return out.select(
        "grid_id", _share(F.col("n_valid"), F.col("n")).alias("valid_pct"), _share(F.col("n_nodata"), F.col("n")).alias("nodata_pct"), _share(F.col("n_unobserved"), F.col("n")).alias("unobserved_pct"),
        F.col("mode.id").alias("mode_id"), _share(F.col("mode.k"), F.col("n_valid")).alias("mode_pct"), F.col("last.id").alias("last_id"), _share(F.col("last.k"), F.col("n_valid")).alias("last_pct"), "n_mode_classes", F.round("shannon", 4).alias("shannon"),
        F.when(any_, F.coalesce("eco.id", F.lit(0))).alias("eco_id"), F.when(any_, F.when(zoned, _share(F.col("eco.k"), F.col("n_zoned"))).otherwise(0.0)).alias("eco_pct"), F.when(any_, F.coalesce(_share(F.coalesce("k_risk", F.lit(0)), F.col("n_zoned")), F.lit(0.0))).alias("risk_pct"),
    )
