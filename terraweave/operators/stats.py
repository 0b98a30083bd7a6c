"""Distributions, bins, correlations, ties and profiles as metric tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.operators import ranks

POINTS = {"p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}


def percentiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float] | None = None) -> DataFrame:
    """(keys, one column a point): exact percentiles, interpolated between neighbours, nulls left out.

    Equal values are counted and their ranks made as in ``ranks``, so no task holds the
    values of a group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_ties"))
    return at_points(ranks.cumulative(counts, keys, "_v"), keys, "_v", points or POINTS)


def at_points(placed: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """The percentiles of ``percentiles`` from equal values with their places, as ``ranks.cumulative`` gives them."""
    upto = F.col("_below") + F.col("_ties")

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_below") <= place) & (place < upto), F.col(value)))

    wanted = {name: F.lit(p) * (F.col("n") - 1) for name, p in points.items()}
    found = placed.groupBy(*keys).agg(F.max("n").alias("n"), *[at(g(w)).alias(f"{name}_{side}") for name, w in wanted.items() for side, g in (("low", F.floor), ("high", F.ceil))])
    part = {name: w - F.floor(w) for name, w in wanted.items()}
    return found.select(*keys, *[(F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * part[name]).alias(name) for name in points])


def distribution(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by, metric, n, missing, min, percentiles, mean, std, max) for each column.

    Percentiles are exact and interpolated, deviation is that of the population, values
    are rounded to 6 digits.
    """
    keys = [*(by or []), "metric"]
    rows = ranks.stacked(df, columns, "metric", "value", by or [])
    r = lambda c: F.round(c, 6)
    out = rows.groupBy(*keys).agg(
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("missing"), r(F.min("value")).alias("min"), r(F.avg("value")).alias("mean"), r(F.stddev_pop("value")).alias("std"), r(F.max("value")).alias("max")
    )
    points = percentiles(rows, keys, "value")
    return ranks._keyed(out, points, keys).select(*out.columns, *[r(F.col(name)).alias(name) for name in POINTS])


def binned_counts(df: DataFrame, column: str, edges: list[float]) -> DataFrame:
    """(bin, rows): half-open bins [edge, next), values outside as below/above, null as missing; empty bins stay."""
    names = ["below", *[f"[{a:g},{b:g})" for a, b in zip(edges, edges[1:])], "above", "missing"]  # noqa: B905
    v = F.col(column)
    number = F.when(v.isNull(), len(names) - 1)
    for i, e in enumerate(edges):
        number = number.when(v < e, i)
    counted = df.groupBy(number.otherwise(len(edges)).alias("i")).agg(F.count("*").alias("rows"))
    bins = df.sparkSession.createDataFrame(list(enumerate(names)), "i int, bin string")
    return bins.join(counted, "i", "left").select("bin", F.coalesce("rows", F.lit(0)).alias("rows"))


def integer_counts(df: DataFrame, column: str, most: int) -> DataFrame:
    """(value, rows) for every integer 0..most."""
    counted = df.groupBy(F.col(column).cast("long").alias("value")).agg(F.count("*").alias("rows"))
    return df.sparkSession.range(most + 1).withColumnRenamed("id", "value").join(counted, "value", "left").select("value", F.coalesce("rows", F.lit(0)).alias("rows"))


def guarded_corr(a: Column, b: Column) -> Column:
    """Pearson correlation of complete pairs; null where n < 2 or a side is constant."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    usable = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(usable, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def correlation_matrix(df: DataFrame, columns: list[str], method: str = "pearson") -> DataFrame:
    """(a, b, method, value) for every pair of columns, one aggregate; rounded to 6 digits."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.round(guarded_corr(F.col(a), F.col(b)), 6).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(method).alias("method"), F.col(f"c{i}").alias("value")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def tie_diagnostics(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    tied = F.col("n") > 1
    return counts.agg(
        F.count("*").alias("distinct_values"), F.count_if(tied).alias("tied_groups"), F.coalesce(F.sum(F.when(tied, F.col("n"))), F.lit(0)).alias("rows_in_ties"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_group")
    )


def score_anchors(df: DataFrame, raw: str, score: str, limits: tuple[int, ...] = (25, 50, 75, 90, 95)) -> DataFrame:
    """(score_limit, rows, least_raw) for rows with score >= limit."""
    wide = df.agg(*[F.count_if(F.col(score) >= t).alias(f"n{t}") for t in limits], *[F.min(F.when(F.col(score) >= t, F.col(raw))).alias(f"m{t}") for t in limits])
    rows = F.array(*[F.struct(F.lit(t).alias("score_limit"), F.col(f"n{t}").alias("rows"), F.col(f"m{t}").cast("double").alias("least_raw")) for t in limits])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def band(column: Column) -> Column:
    return F.when(column < 25, "0-25").when(column < 50, "25-50").when(column < 75, "50-75").otherwise("75-100")


def joint_bands(df: DataFrame, a: str, b: str) -> DataFrame:
    """(band_a, band_b, rows): counts of two banded scores."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(band(F.col(a)).alias("band_a"), band(F.col(b)).alias("band_b")).agg(F.count("*").alias("rows"))


def coordinate_thirds(df: DataFrame) -> DataFrame:
    """(third_x, third_y, rows) over the extent, thirds left-closed."""
    extent = df.agg(F.min("grid_col").alias("x0"), F.max("grid_col").alias("x1"), F.min("grid_row").alias("y0"), F.max("grid_row").alias("y1"))

    def third(v: str, low: str, high: str) -> Column:
        step = (F.col(high) - F.col(low)) / F.lit(3.0)
        return F.when(F.col(v) < F.col(low) + step, "low").when(F.col(v) < F.col(low) + 2 * step, "middle").otherwise("high")

    return df.join(F.broadcast(extent)).groupBy(third("grid_col", "x0", "x1").alias("third_x"), third("grid_row", "y0", "y1").alias("third_y")).agg(F.count("*").alias("rows"))


def threshold_counts(df: DataFrame, conditions: dict[str, Column], value: str) -> DataFrame:
    """(condition, rows, median of ``value``) of the rows that meet each condition; one without rows has a null median."""
    names = F.array_compact(F.array(*[F.when(c, name) for name, c in conditions.items()]))
    rows = df.select(F.explode(names).alias("condition"), F.col(value).alias("_v"))
    every = df.sparkSession.createDataFrame([(name,) for name in conditions], "condition string")
    counted = rows.groupBy("condition").agg(F.count("*").alias("rows"))
    return every.join(counted, "condition", "left").join(percentiles(rows, ["condition"], "_v", {"median": 0.5}), "condition", "left").select("condition", F.coalesce("rows", F.lit(0)).alias("rows"), "median")
