"""Cloud and shadow masks of images: quality bits, brightness, dark outliers in time, and shadows cast by clouds.

An image is the observations of one ``scene``, at most one for each pixel; a pixel that an image lacks is no row.  Minimum and
maximum over a neighbourhood go along the rows first, then along the columns: for a reach r that is 2 (2r + 1) rows for each
pixel instead of (2r + 1)², and holes in an image are looked across.  A mask's few true pixels are spread instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.functions import indices as ix
from terrapanel.sources.shared import table


def half_widths(reach: int, shape: str = "circle") -> dict[int, int]:
    """How far a neighbourhood goes along the row that lies so many rows away."""
    return {d: math.isqrt(reach * reach - d * d) if shape == "circle" else reach for d in range(-reach, reach + 1)}


def _offsets(name: str, steps: Sequence[int]) -> Column:
    return F.explode(F.array(*map(F.lit, steps))).alias(name)


def focal_extreme(pixels: DataFrame, value: str, reach: int, least: bool, keys: Sequence[str] = (), shape: str = "circle") -> DataFrame:
    """``pixels`` with ``focal``, the least (or greatest) ``value`` within ``reach`` pixels; nulls and holes don't count."""
    width, pick = half_widths(reach, shape), F.min if least else F.max
    across = pixels.select(*keys, "px_row", "px_col", F.col(value).alias("v"), _offsets("dc", range(-reach, reach + 1)))
    rows = across.groupBy(*keys, "px_row", (F.col("px_col") + F.col("dc")).alias("px_col")).agg(*(pick(F.when(F.abs("dc") <= w, F.col("v"))).alias(f"w{w}") for w in sorted(set(width.values()))))
    down = rows.select(*keys, "px_row", "px_col", *(f"w{w}" for w in sorted(set(width.values()))), _offsets("dr", range(-reach, reach + 1)))
    mine = F.coalesce(*(F.when(F.col("dr") == d, F.col(f"w{w}")) for d, w in width.items()))
    found = down.groupBy(*keys, (F.col("px_row") + F.col("dr")).alias("px_row"), "px_col").agg(pick(mine).alias("focal"))
    return pixels.join(found, [*keys, "px_row", "px_col"], "left")


def spread(marked: DataFrame, reach: int, keys: Sequence[str] = (), shape: str = "circle") -> DataFrame:
    """The places within ``reach`` pixels of the marked ones, each once."""
    width = half_widths(reach, shape)
    around = F.explode(F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, w in width.items() for c in range(-w, w + 1))))
    return marked.select(*keys, "px_row", "px_col", around.alias("o")).select(*keys, (F.col("px_row") + F.col("o.r")).alias("px_row"), (F.col("px_col") + F.col("o.c")).alias("px_col")).distinct()


def dark_outlier_mask(images: DataFrame, scene: Sequence[str], nir: str = "nir", swir: str = "swir1", z: float = -1.0, most: float = 0.5, reach: int = 2) -> DataFrame:
    """``images`` with ``tdomMask``: pixels darker than usual in both bands, and dark in sum, as are all within ``reach``.

    A band that never changes has no outliers.
    """
    w = Window.partitionBy("px_row", "px_col")
    score = lambda b: F.try_divide(F.col(b) - F.avg(b).over(w), F.stddev_pop(b).over(w))
    dark = F.coalesce((score(nir) < z) & (score(swir) < z) & (F.col(nir) + F.col(swir) < most), F.lit(False))
    marked = images.withColumn("dark", dark.cast("int"))
    return focal_extreme(marked, "dark", reach, True, scene).withColumn("tdomMask", F.col("focal") == 1).drop("dark", "focal")


def shadow_offset(azimuth: Column, elevation: Column, height: Column, size: float) -> tuple[Column, Column]:
    """Rows and columns from a cloud to its shadow, for the sun's azimuth and elevation in degrees, and a pixel size in metres."""
    way = F.tan(F.lit(0.5 * math.pi) - elevation * math.pi / 180.0) * height
    turn = azimuth * math.pi / 180.0 + 0.5 * math.pi
    return F.round(F.sin(turn) * way / size).cast("int"), F.round(F.cos(turn) * way / size).cast("int")


def project_shadows(images: DataFrame, scene: Sequence[str], cloud: str, suns: DataFrame, heights: Sequence[float], size: float, most: float = 0.5, reach: int = 2) -> DataFrame:
    """``images`` with ``cloudShadowTdomMask``: where the clouds of column ``cloud`` would cast shadows.

    ``suns`` has the ``scene`` columns, ``sun_azimuth_angle`` and ``sun_elevation_angle``.  Clouds are moved by the way of the shadow
    for each height, and spread by ``reach``; a shadow counts where near and short-wave infrared are dark in sum, and where neither
    ``tdomMask`` nor ``cloud`` holds.  Scenes without a known sun cast none.
    """
    d_row, d_col = shadow_offset(F.col("sun_azimuth_angle"), F.col("sun_elevation_angle"), F.col("h"), size)
    ways = suns.where("sun_azimuth_angle is not null and sun_elevation_angle is not null").withColumn("h", F.explode(F.array(*(F.lit(float(h)) for h in heights)))).select(*scene, d_row.alias("d_row"), d_col.alias("d_col")).distinct()
    moved = images.where(cloud).select(*scene, "px_row", "px_col").join(ways, list(scene)).select(*scene, (F.col("px_row") + F.col("d_row")).alias("px_row"), (F.col("px_col") + F.col("d_col")).alias("px_col")).distinct()
    shade = spread(moved, reach, scene).withColumn("shade", F.lit(True))
    dark = F.coalesce(F.col("nir") + F.col("swir1") + F.col("swir2") < most, F.lit(False))
    out = images.join(shade, [*scene, "px_row", "px_col"], "left")
    return out.withColumn("cloudShadowTdomMask", F.coalesce("shade", F.lit(False)) & dark & ~F.col("tdomMask") & ~F.col(cloud)).drop("shade")


def all_masks(
    images: DataFrame,
    scene: Sequence[str],
    suns: DataFrame,
    heights: Sequence[float],
    size: float,
    *,
    cloud_flag: bool = True,
    cloud_score: bool = True,
    shadow_flag: bool = True,
    shadow_tdom: bool = True,
    cloud_band: str = "cloudFlagMask",
    score_over: float = 0.1,
    z: float = -1.0,
    most: float = 0.5,
    reach: int = 2,
) -> DataFrame:
    """``images`` with the masks that the flags ask for: ``cloudFlagMask``, ``cloudScoreMask``, ``cloudShadowFlagMask``,
    ``tdomMask`` and ``cloudShadowTdomMask``.

    Without ``cloud_flag`` brightness decides on clouds even if ``cloud_score`` is off, and without ``shadow_flag`` there are dark
    outliers even if ``shadow_tdom`` is off; shadows are projected with ``shadow_tdom`` only, from the clouds of ``cloud_band``.
    """
    bits = ix.quality_masks(F.col("qa"))
    out = images
    if cloud_flag:
        out = out.withColumn("cloudFlagMask", F.coalesce(bits["cloud"], F.lit(False)))
    if cloud_score or not cloud_flag:
        out = out.withColumn("cloudScoreMask", F.coalesce(ix.cloud_score(*(F.col(b) for b in ("blue", "green", "red", "nir", "swir1", "swir2"))) > score_over, F.lit(False)))
    if shadow_flag:
        out = out.withColumn("cloudShadowFlagMask", F.coalesce(bits["shadow"], F.lit(False)))
    if shadow_tdom or not shadow_flag:
        out = table(dark_outlier_mask(out, scene, z=z, most=most, reach=reach), "dark-outliers")
    if shadow_tdom:
        out = project_shadows(out, scene, cloud_band, suns, heights, size, most, reach)
    return out


MASKS = ("cloudFlagMask", "cloudScoreMask", "cloudShadowFlagMask", "tdomMask", "cloudShadowTdomMask")


def apply_masks(images: DataFrame, masks: Sequence[str] = MASKS) -> DataFrame:
    """The observations that no mask covers; masks that an image doesn't have are passed over."""
    there = [F.coalesce(F.col(m), F.lit(False)) for m in masks if m in images.columns]
    hidden = F.lit(False)
    for m in there:
        hidden = hidden | m
    return images.where(~hidden)
