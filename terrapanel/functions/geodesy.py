"""Areas, distances and zones on the ellipsoid as Columns; only the geodesic itself is a pandas UDF."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The WGS 84 ellipsoid, and the scale of a UTM zone's central meridian.
A, INV_F, K0 = 6378137.0, 298.257223563, 0.9996
_F = 1 / INV_F
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)
_B = A * (1 - _F)


def _q(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    return (1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def quad_area_ha(lon_w: Column, lat_s: Column, lon_e: Column, lat_n: Column) -> Column:
    """Exact area of a quadrangle of meridians and parallels by the authalic latitude, in hectares."""
    return A * A * F.radians(lon_e - lon_w) * (_q(lat_n) - _q(lat_s)) / 2 / 10000


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def utm_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone that a point is in."""
    return utm_zone(lon) + F.when(lat < 0, 32700).otherwise(32600)


def utm_areal_scale(easting: Column) -> Column:
    """How much a UTM map enlarges areas at an easting."""
    return F.pow(K0 * (1 + F.pow((easting - 500000) / 6371000, 2) / 2), 2)


@F.pandas_udf(T.DoubleType())
def geodesic_m(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Length of the geodesic between points (Vincenty's inverse), 0 for equal points, null for antipodes."""
    with np.errstate(all="ignore"):
        u1, u2 = (np.arctan((1 - _F) * np.tan(np.radians(x.to_numpy(float)))) for x in (lat1, lat2))
        dl = np.radians(lon2.to_numpy(float) - lon1.to_numpy(float))
        lam = dl.copy()
        for _ in range(60):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(np.cos(u2) * sl, np.cos(u1) * np.sin(u2) - np.sin(u1) * np.cos(u2) * cl)
            cs = np.sin(u1) * np.sin(u2) + np.cos(u1) * np.cos(u2) * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0, np.cos(u1) * np.cos(u2) * sl / np.where(ss == 0, 1, ss))
            ca2 = 1 - sa * sa
            cm = np.where(ca2 == 0, 0, cs - 2 * np.sin(u1) * np.sin(u2) / np.where(ca2 == 0, 1, ca2))
            c = _F / 16 * ca2 * (4 + _F * (4 - 3 * ca2))
            new = dl + (1 - c) * _F * sa * (sigma + c * ss * (cm + c * cs * (2 * cm * cm - 1)))
            done = np.nanmax(np.abs(new - lam), initial=0) < 1e-12
            lam = new
            if done:
                break
        k = ca2 * (A * A - _B * _B) / (_B * _B)
        big = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
        small = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
        d = small * ss * (cm + small / 4 * (cs * (2 * cm * cm - 1) - small / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
        return pd.Series(np.where(ss == 0, 0.0, _B * big * (sigma - d)))
