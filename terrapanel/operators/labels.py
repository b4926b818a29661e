"""Zonal statistics, majority labels, review edits and agreement over segment and patch tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def zonal_stats(pixels: DataFrame, segment: str, bands: Sequence[str], valid: str = "valid") -> DataFrame:
    """Mean, median and population deviation of every band over a segment's valid pixels, counts and no-data share."""
    v = F.col(valid)
    aggs = [f(F.when(v, F.col(b))).alias(f"{b}_{n}") for b in bands for n, f in (("mean", F.avg), ("median", F.median), ("std", F.stddev_pop))]
    out = pixels.groupBy(segment).agg(F.count("*").alias("n_px"), F.count(F.when(v, 1)).alias("n_valid"), *aggs)
    rounded = [F.round(c, 4).alias(c) for c in out.columns if c.endswith(("_mean", "_median", "_std"))]
    return out.select(segment, "n_px", "n_valid", F.round(1 - F.col("n_valid") / F.col("n_px"), 4).alias("nodata_share"), *rounded)


def shapes(pixels: DataFrame, segment: str) -> DataFrame:
    """Area and perimeter in pixels, compactness, and elongation by second moments.

    A pixel side counts for the perimeter if the pixel beyond belongs to another segment or to none.
    """
    sides = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 1), (1, 0), (0, -1), (-1, 0))))
    ahead = pixels.select(F.col(segment).alias("s"), F.explode(sides).alias("o"), "px_row", "px_col").select("s", (F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col"))
    inner = ahead.join(pixels.select("px_row", "px_col", F.col(segment).alias("t")), ["px_row", "px_col"]).where("s = t").groupBy("s").agg(F.count("*").alias("inner"))
    m = pixels.groupBy(F.col(segment).alias("s")).agg(F.count("*").alias("area"), F.var_pop("px_row").alias("vr"), F.var_pop("px_col").alias("vc"), F.covar_pop(F.col("px_row").cast("double"), F.col("px_col").cast("double")).alias("cov"))
    out = m.join(inner, "s", "left").withColumn("perimeter", 4 * F.col("area") - F.coalesce("inner", F.lit(0)))
    half, root = (F.col("vr") + F.col("vc")) / 2 + 1 / 12, F.sqrt(F.pow((F.col("vr") - F.col("vc")) / 2, 2) + F.pow("cov", 2))
    return out.select(F.col("s").alias(segment), "area", "perimeter", F.round(4 * 3.141592653589793 * F.col("area") / F.pow("perimeter", 2), 4).alias("compactness"), F.round(F.sqrt((half + root) / F.greatest(half - root, F.lit(1 / 12))), 4).alias("elongation"))


def class_counts(pixels: DataFrame, segment: str, value: str, no_data: Sequence[int]) -> DataFrame:
    """Ranked classes of each segment's valid pixels: count descending, then class."""
    counts = pixels.where(~F.col(value).isin(*no_data)).groupBy(segment, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(segment)
    return counts.withColumn("rank", F.row_number().over(w.orderBy(F.desc("n"), value))).withColumn("n_valid", F.sum("n").over(w)).withColumn("n_classes", F.count("*").over(w))


def majority(pixels: DataFrame, segment: str, value: str, no_data: Sequence[int] = (0,)) -> DataFrame:
    """Most frequent class of each segment with its purity (of valid pixels) and coverage (valid of all)."""
    top = class_counts(pixels, segment, value, no_data).where("rank = 1").select(segment, F.col(value).alias("mode_class"), "n", "n_valid")
    whole = pixels.groupBy(segment).agg(F.count("*").alias("area_px"))
    return whole.join(top, segment, "left").select(segment, "area_px", F.coalesce("n_valid", F.lit(0)).alias("n_valid"), "mode_class", F.round(F.coalesce(F.col("n") / F.col("n_valid"), F.lit(0.0)), 4).alias("purity"), F.round(F.coalesce("n_valid", F.lit(0)) / F.col("area_px"), 4).alias("coverage"))


def top_classes(pixels: DataFrame, segment: str, value: str, protected: Sequence[int], no_data: Sequence[int] = (0,)) -> DataFrame:
    """The three most frequent classes of each segment and their shares, the number of classes, whether one is protected."""
    ranked = class_counts(pixels, segment, value, no_data)
    at = lambda k, c: F.max(F.when(F.col("rank") == k, c))
    aggs = [x for k in (1, 2, 3) for x in (F.coalesce(at(k, F.col(value)), F.lit(0)).alias(f"class_{k}"), F.round(F.coalesce(at(k, 100.0 * F.col("n") / F.col("n_valid")), F.lit(0.0)), 2).alias(f"share_{k}"))]
    return ranked.groupBy(segment).agg(F.max("n_classes").alias("n_classes"), *aggs, F.bool_or(F.col(value).isin(*protected)).alias("has_protected"))


def assign(labels: DataFrame, purity: float, coverage: float, least: int) -> DataFrame:
    """``ok``, ``mixed`` or ``no_data`` of each segment, and its class, 255 or 254."""
    none = (F.col("n_valid") < least) | (F.col("coverage") < coverage) | F.col("mode_class").isNull()
    status = F.when(none, "no_data").when(F.col("purity") < purity, "mixed").otherwise("ok")
    return labels.withColumn("status", status).withColumn("label", F.when(F.col("status") == "ok", F.col("mode_class")).when(F.col("status") == "mixed", 255).otherwise(254))


def threshold_sweep(labels: DataFrame, taus: Sequence[float], coverage: float, least: int) -> DataFrame:
    """Segments and pixels of each status for each purity threshold."""
    spark = labels.sparkSession
    t = F.broadcast(spark.createDataFrame([(float(x),) for x in taus], "tau double"))
    none = (F.col("n_valid") < least) | (F.col("coverage") < coverage) | F.col("mode_class").isNull()
    return labels.crossJoin(t).withColumn("status", F.when(none, "no_data").when(F.col("purity") < F.col("tau"), "mixed").otherwise("ok")).groupBy("tau", "status").agg(F.count("*").alias("n"), F.sum("area_px").alias("px"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, weight: str) -> DataFrame:
    """Counts and weights by equal bins; values at the top belong to the last bin."""
    b = F.least(F.floor((F.col(value) - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.sum(weight).alias("weight"))


def confusion(pairs: DataFrame, truth: str, guess: str) -> DataFrame:
    return pairs.where(F.col(truth).isNotNull() & F.col(guess).isNotNull()).groupBy(truth, guess).agg(F.count("*").alias("n"))


def agreement(pairs: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and Cohen's kappa by group, from the counts of each combination; kappa is null where chance explains all."""
    cells = pairs.where(F.col(truth).isNotNull() & F.col(guess).isNotNull()).groupBy(*by, F.col(truth).alias("t"), F.col(guess).alias("g")).agg(F.count("*").alias("n"))
    rows, cols = cells.groupBy(*by, F.col("t").alias("c")).agg(F.sum("n").alias("r")), cells.groupBy(*by, F.col("g").alias("c")).agg(F.sum("n").alias("k"))
    chance = rows.join(cols, [*by, "c"]).groupBy(*by).agg(F.sum(F.col("r") * F.col("k")).alias("chance"))
    base = cells.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("t") == F.col("g"), F.col("n")).otherwise(0)).alias("same"))
    out = base.join(chance, list(by), "left") if by else base.crossJoin(F.broadcast(chance))
    po, pe = F.col("same") / F.col("n"), F.coalesce("chance", F.lit(0)) / F.pow("n", 2)
    return out.select(*by, "n", F.round(po, 4).alias("accuracy"), F.round(F.try_divide(po - pe, 1 - pe), 4).alias("kappa"))


def effective_label(df: DataFrame) -> DataFrame:
    """Defaults for missing review fields, and the label in effect: the correction if there is one, else the class."""
    filled = df.withColumn("poly_qa", F.coalesce("poly_qa", F.lit("pending"))).withColumn("corr_id", F.coalesce("corr_id", F.lit(0)))
    return filled.withColumn("lbl_id", F.when(F.col("corr_id") > 0, F.col("corr_id")).otherwise(F.col("class_id")))


def approved_share(df: DataFrame, keys: Sequence[str], area: str = "area_ha") -> DataFrame:
    """The approved share of a rectangle's area, on each of its rows."""
    w = Window.partitionBy(*keys)
    return df.withColumn("cov_rect", F.round(F.coalesce(F.try_divide(F.sum(F.when(F.col("poly_qa") == "approved", F.col(area)).otherwise(0.0)).over(w), F.sum(area).over(w)), F.lit(0.0)), 4))


def apply_edits(patches: DataFrame, edits: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Edited fields replace old ones where an edit has a value; the latest edit of a key wins (``seq``)."""
    last = edits.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("seq")))).where("rank = 1").select(key, *(F.col(f).alias(f"_{f}") for f in fields))
    return patches.join(last, key, "left").select(*(F.coalesce(f"_{f}", f).alias(f) if f in fields else F.col(f) for f in patches.columns))


def constraint_report(df: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """One row for each broken rule and row: ``rule, severity, key``; all rules in one pass."""
    hits = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(name).alias("rule"), F.lit(sev).alias("severity"))) for name, (sev, c) in rules.items())))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(hits).alias("h")).select("h.rule", "h.severity", "key")


def first_shared_key(answers: DataFrame, reference: DataFrame, keys: Sequence[str] = ("review_id", "segment_uid")) -> str:
    """The first of the keys that both tables have."""
    for k in keys:
        if k in answers.columns and k in reference.columns:
            return k
    raise ValueError(f"no key in both tables: one of {', '.join(keys)} is needed")


def answers_with_reference(answers: dict[str, DataFrame], reference: DataFrame, truth: str, given: str, keys: Sequence[str] = ("review_id", "segment_uid")) -> DataFrame:
    """``reviewer, truth, given`` for every row of the reference that has a class, for each reviewer.

    A reviewer's table is joined on the first key that it shares with the reference; classes that are no numbers count as none; the
    reviewer is ``reviewer_id``, the first that isn't null, or the name of the table.  Answers given more than once are all kept.
    """
    known = reference.withColumn(truth, F.col(truth).try_cast("double").cast("int")).where(F.col(truth).isNotNull())
    out = None
    for name, df in answers.items():
        key = first_shared_key(df, reference, keys)
        who = F.lit(name)
        if "reviewer_id" in df.columns:
            first = df.where("reviewer_id is not null").agg(F.min("reviewer_id").alias("r")).first()["r"]
            who = F.lit(name if first is None else str(first))
        mine = known.join(df.select(key, F.col(given).try_cast("double").cast("int").alias(given)), key, "left").select(who.alias("reviewer"), F.col(truth).alias("truth"), F.col(given).alias("given"))
        out = mine if out is None else out.unionByName(mine)
    return out


#: Columns that reviewers get, and what stands for no label.
REVIEW_COLUMNS = ("grid_id", "sample_type", "review_years", "lulc_mode_name", "eco_dom_name", "target_rare_class", "review_label", "review_notes")


def clean_label(text: Column, none: str = "none") -> Column:
    """A label without blanks around it and with single ones inside; nothing, or what tables write for it, is ``none``."""
    plain = F.trim(F.regexp_replace(text.cast("string"), r"\s+", " "))
    return F.when(F.lower(plain).isin("", "nan", "none", "null"), none).otherwise(F.coalesce(plain, F.lit(none)))


def prepare_columns(df: DataFrame, labels: Sequence[str], columns: Sequence[str] = REVIEW_COLUMNS) -> DataFrame:
    """The columns of a review in order: those that the table has, labels cleaned, others as text; the rest empty."""
    return df.select(*((clean_label(F.col(c)) if c in labels else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))
