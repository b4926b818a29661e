"""Spectral indices, bit masks, unmixing and scaling as Columns over band columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _nd(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


def indices(blue: Column, green: Column, red: Column, nir: Column, swir1: Column, swir2: Column) -> dict[str, Column]:
    """The spectral indices of reflectances in 0 to 1; null where a denominator is 0.

    NDWI equals NDMI and MNDWI equals NDSI by definition here.
    """
    ui, ndvi = _nd(swir2, nir), _nd(nir, red)
    ndbi, savi = _nd(swir1, nir), F.try_divide(1.5 * (nir - red), nir + red + 0.5)
    return {
        "ndvi": ndvi, "ndbi": ndbi, "ndmi": _nd(nir, swir1), "ndsi": _nd(green, swir1), "ui": ui, "ndwi": _nd(nir, swir1), "mndwi": _nd(green, swir1),
        "mbi": F.try_divide(swir1 - swir2 - nir, swir1 + swir2 + nir) + 0.5, "bu": ndbi - ndvi, "ebbi": F.try_divide(swir1 - nir, 10 * F.sqrt(swir1 + swir2)),
        "savi": savi, "pri": _nd(blue, green), "cai": F.try_divide(swir2, swir1), "evi": F.try_divide(2.5 * (nir - red), nir + 6 * red - 7.5 * blue + 1),
        "evi2": F.try_divide(2.5 * (nir - red), nir + 2.4 * red + 1), "gcvi": F.try_divide(nir, green) - 1,
        "hall_cover": F.exp(-0.017 * red * 100 - 0.007 * nir * 100 - 0.079 * swir2 * 100 + 5.22), "hall_height": F.exp(-0.039 * red * 100 - 0.011 * nir * 100 - 0.026 * swir1 * 100 + 4.13),
    }


def bit(qa: Column, n: int) -> Column:
    """Whether bit ``n`` of a quality word is set."""
    return qa.bitwiseAND(F.lit(1 << n)) != 0


def quality_masks(qa: Column, sensor: str = "landsat") -> dict[str, Column]:
    """Cloud and shadow flags by sensor: bits 3 and 4, or 10 and 11 (cirrus) of the second kind."""
    cloud, other = (3, 4) if sensor == "landsat" else (10, 11)
    return {"cloud": bit(qa, cloud), "shadow": bit(qa, other)}


def rescale(x: Column, low: float, high: float) -> Column:
    return (x - low) / (high - low)


def cloud_score(blue: Column, green: Column, red: Column, nir: Column, swir1: Column, swir2: Column) -> Column:
    """Least of the rescaled brightness tests and of not being snow, in 0 to 1."""
    tests = [rescale(blue, 0.1, 0.3), rescale(blue + green + red, 0.2, 0.8), rescale(nir + swir1 + swir2, 0.3, 0.8), rescale(_nd(green, swir1), 0.8, 0.6)]
    return F.least(F.lit(1.0), *(F.greatest(t, F.lit(0.0)) for t in tests))


def unmix(bands: Sequence[Column], endmembers: dict[str, Sequence[float]], signed: bool = False) -> dict[str, Column]:
    """Least-squares fractions of the endmembers in percent, and the shade that is left.

    The pseudo-inverse is a constant, so each fraction is a weighted sum of bands.
    """
    weights = np.linalg.pinv(np.array(list(endmembers.values())).T)
    out = {}
    for name, row in zip(endmembers, weights, strict=True):
        value = sum((float(w) * b for w, b in zip(row, bands, strict=True)), F.lit(0.0)) * 100
        out[name] = value if signed else F.greatest(value, F.lit(0.0))
    out["shade"] = F.lit(100.0) - sum(out.values(), F.lit(0.0))
    return out


def fraction_indices(gv: Column, npv: Column, soil: Column, cloud: Column, shade: Column) -> dict[str, Column]:
    """Indices of fractions in percent, moved from -1..1 to 0..200."""
    gvs = F.try_divide(gv, gv + npv + soil + cloud) * 100
    wide = lambda x: F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(-1.0)), F.lit(1.0)) * 100 + 100)
    return {"gvs": gvs, "ndfi": wide(_nd(gvs, npv + soil)), "sefi": wide(_nd(gv + npv, soil)), "wefi": wide(_nd(gv + npv, soil + shade)), "fns": wide(_nd(gv + shade, soil))}


def stretch(df: DataFrame, keys: Sequence[str], bands: Sequence[str], low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Bands stretched to 0..255 between two percentiles of each group."""
    marks = df.groupBy(*keys).agg(*(F.percentile(b, F.array(F.lit(low), F.lit(high))).alias(f"_{b}") for b in bands))
    joined = df.join(marks, list(keys))
    for b in bands:
        p0, p1 = F.col(f"_{b}")[0], F.col(f"_{b}")[1]
        joined = joined.withColumn(b, F.floor(F.least(F.greatest(F.coalesce(F.try_divide(F.col(b) - p0, p1 - p0), F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * 255).cast("int"))
    return joined.drop(*(f"_{b}" for b in bands))


def z_scores(df: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """Bands less their mean over their population deviation by group; deviations of 0 count as 1, nulls get the median first."""
    medians = df.groupBy(*keys).agg(*(F.median(b).alias(f"_{b}") for b in bands))
    filled = df.join(medians, list(keys))
    filled = filled.select(*keys, *(c for c in df.columns if c not in keys and c not in bands), *(F.coalesce(b, f"_{b}").alias(b) for b in bands))
    moments = filled.groupBy(*keys).agg(*(F.avg(b).alias(f"_m{b}") for b in bands), *(F.stddev_pop(b).alias(f"_s{b}") for b in bands))
    out = filled.join(moments, list(keys))
    for b in bands:
        out = out.withColumn(b, (F.col(b) - F.col(f"_m{b}")) / F.when(F.col(f"_s{b}") > 0, F.col(f"_s{b}")).otherwise(1.0))
    return out.drop(*(f"_m{b}" for b in bands), *(f"_s{b}" for b in bands))
