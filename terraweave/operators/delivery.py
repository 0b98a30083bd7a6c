"""Delivery: lon/lat, rounding, feature rows and shortlists."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import ranks

# GRS80 and the national projection zone.
_A, _F_INV, _K0, _LON0, _EAST0 = 6378137.0, 298.257222101, 0.9996, 15.0, 500000.0


def lon_lat(x: Column, y: Column, digits: int = 6) -> tuple[Column, Column]:
    """Inverse transverse Mercator series of Krueger in closed form."""
    f = 1 / _F_INV
    n = f / (2 - f)
    a = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    d = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    g = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    xi, eta = y / F.lit(_K0 * a), (x - F.lit(_EAST0)) / F.lit(_K0 * a)
    xi_ = reduce(lambda s, j: s - F.lit(d[j]) * F.sin(F.lit(2.0 * (j + 1)) * xi) * F.cosh(F.lit(2.0 * (j + 1)) * eta), range(3), xi)
    eta_ = reduce(lambda s, j: s - F.lit(d[j]) * F.cos(F.lit(2.0 * (j + 1)) * xi) * F.sinh(F.lit(2.0 * (j + 1)) * eta), range(3), eta)
    chi = F.asin(F.sin(xi_) / F.cosh(eta_))
    lat = reduce(lambda s, j: s + F.lit(g[j]) * F.sin(F.lit(2.0 * (j + 1)) * chi), range(3), chi)
    lon = F.lit(math.radians(_LON0)) + F.atan2(F.sinh(eta_), F.cos(xi_))
    return F.round(F.degrees(lon), digits), F.round(F.degrees(lat), digits)


def exact_round(digits: int):
    """Rounds the exact binary value, halves to even, -0 to 0; Spark's round takes the shortest decimal.

    value * 10**digits is taken with its rounding error (a product of halves of the two
    numbers), so the remainder over the whole part is known exactly and compares with 0.5.
    Null, NaN and values too large to have digits stay.
    """
    scale = 10.0**digits
    halves = lambda v: (F.lit(134217729.0) * v - (F.lit(134217729.0) * v - v),)
    top = 134217729.0 * scale - (134217729.0 * scale - scale)
    rest = scale - top

    def rounded(value: Column) -> Column:
        value = value.cast("double")
        product = value * F.lit(scale)
        (high,) = halves(value)
        low = value - high
        error = ((high * F.lit(top) - product) + high * F.lit(rest) + low * F.lit(top)) + low * F.lit(rest)
        whole = F.floor(product).cast("double")
        over = (product - (whole + 0.5)) + error
        up = (over > 0) | ((over == 0) & (F.pmod(whole, F.lit(2.0)) == 1))
        small = F.abs(product) < F.lit(float(1 << 52))
        return F.when(small, F.when(up, whole + 1).otherwise(whole) / F.lit(scale) + F.lit(0.0)).otherwise(value)

    return rounded


def shortlists(presets: DataFrame, names: list[str], n: int = 50) -> DataFrame:
    """(preset, rank, hex_id, score): best n of each preset by unrounded score, ties by id; one pass for all presets."""
    return ranks.best_by(ranks.stacked(presets, names, "preset", "score", ["hex_id"]), "preset", [F.col("score").desc(), F.col("hex_id")], n)


def features(df: DataFrame, properties: list[str]) -> DataFrame:
    """(hex_id, feature): one GeoJSON text a cell, corners in lon/lat, ring closed."""
    corners = hexgrid.polygon(F.col("grid_col"), F.col("grid_row"))
    ring = F.transform(corners, lambda c: F.array(*lon_lat(c["x"], c["y"])))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.concat(ring, F.slice(ring, 1, 1))).alias("coordinates"))
    return df.select("hex_id", F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("hex_id").alias("id"), F.struct(*properties).alias("properties"), geometry.alias("geometry"))).alias("feature"))
