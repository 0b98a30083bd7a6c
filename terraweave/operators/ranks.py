"""Average ranks, percentile scores, ordinal ranks and top fractions without a global window.

Rows are sorted once by Spark's range partitioning, which splits by the sampled data, and
written with their places. A rank is the place inside the part plus the sizes of the parts
before it, one row a part. The order ends with the id, so a value that many rows share is
split as well. Average ranks first count equal values, with map-side combination, and sort
the distinct ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraweave.sources.storage import materialise


def _part() -> Column:
    return F.shiftright("_place", 33).cast("int").alias("_part")


def _sorted(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` written in order, with _part (rises with the order) and _place (rises inside a part, from 0)."""
    placed = materialise(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), name)
    return placed.select(*df.columns, _part(), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"))


def _starts(sizes: DataFrame) -> DataFrame:
    """(_part, _start) from (_part, _size); one row a part."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")))


def _keyed(df: DataFrame, right: DataFrame, keys: list[str], extra: dict[str, str] | None = None) -> DataFrame:
    """Left join on null-safe keys (and pairs of columns, left: right)."""
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    for a, b in (extra or {}).items():
        on = on & (F.col(a) == F.col(b))
    return df.join(renamed, on, "left").drop(*[f"_k_{k}" for k in keys])


def cumulative(counts: DataFrame, keys: list[str], value: str, ties: str = "_ties") -> DataFrame:
    """``counts`` (keys, value, ties; one row a value) with _below and n: rows of smaller values and all rows, by group."""
    placed = _sorted(counts, [*keys, value], "value-ranks")
    starts = _starts(placed.groupBy("_part").agg(F.sum(ties).alias("_size")))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    upto = placed.withColumn("_inside", F.coalesce(F.sum(ties).over(inside), F.lit(0))).join(starts, "_part")
    upto = upto.select(*counts.columns, (F.col("_start") + F.col("_inside")).alias("_before"))
    groups = upto.groupBy(*keys).agg(F.min("_before").alias("_first"), F.sum(ties).alias("n"))
    joined = _keyed(upto, groups, keys) if keys else upto.join(F.broadcast(groups))
    return joined.withColumn("_below", F.col("_before") - F.col("_first")).drop("_before", "_first")


def average_ranks(df: DataFrame, column: str, within: list[str] | None = None) -> DataFrame:
    """``df`` with rank_avg (from 1, ties share the mean) and n, over non-null values.

    within: columns that split the population (for example a scheme). Null values get a
    null rank and don't count. Empty table: no rows.
    """
    keys = within or []
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_value")).agg(F.count("*").alias("_ties"))
    ranked = cumulative(counts, keys, "_value").select(*keys, "_value", (F.col("_below") + (F.col("_ties") + 1) / F.lit(2.0)).alias("rank_avg"), "n")
    return _keyed(df, ranked, keys, {column: "_value"}).drop("_value")


def percentile_score(df: DataFrame, column: str, name: str = "score", **options) -> DataFrame:
    """100 * (average rank - 1) / (n - 1); 0 where n is 1."""
    ranked = average_ranks(df, column, **options)
    return ranked.withColumn(name, F.when(F.col("n") > 1, F.lit(100.0) * (F.col("rank_avg") - 1) / (F.col("n") - 1)).when(F.col("n") == 1, 0.0)).drop("rank_avg", "n")


def rank_fraction(df: DataFrame, column: str, name: str, **options) -> DataFrame:
    """Average rank / n, in (0, 1]."""
    return average_ranks(df, column, **options).withColumn(name, F.col("rank_avg") / F.col("n")).drop("rank_avg", "n")


def positive_percentile_score(df: DataFrame, column: str, name: str = "score", **options) -> DataFrame:
    """Zero scores 0; positive values score 100 * average rank / n among the positive."""
    positive = df.withColumn("_positive", F.when(F.col(column) > 0, F.col(column)))
    ranked = average_ranks(positive, "_positive", **options)
    return ranked.withColumn(name, F.when(F.col(column) == 0, 0.0).otherwise(F.lit(100.0) * F.col("rank_avg") / F.col("n"))).drop("rank_avg", "n", "_positive")


def reverse_score(df: DataFrame, column: str, name: str = "score", **options) -> DataFrame:
    """Zero steps score 100; positive ones 100 * (n - average rank + 1) / (n + 1)."""
    positive = df.withColumn("_positive", F.when(F.col(column) > 0, F.col(column)))
    ranked = average_ranks(positive, "_positive", **options)
    return ranked.withColumn(name, F.when(F.col(column) == 0, 100.0).otherwise(F.lit(100.0) * (F.col("n") - F.col("rank_avg") + 1) / (F.col("n") + 1))).drop("rank_avg", "n", "_positive")


def ordinal_ranks(df: DataFrame, column: str, id_col: str = "hex_id", name: str = "rank", within: list[str] | None = None) -> DataFrame:
    """1..n by (column descending, id ascending), nulls last; within groups if given."""
    keys = within or []
    placed = _sorted(df, [*keys, F.col(column).desc_nulls_last(), F.col(id_col)], "ordinal-ranks")
    starts = _starts(placed.groupBy("_part").agg(F.count("*").alias("_size")))
    ranked = placed.join(starts, "_part").withColumn(name, (F.col("_start") + F.col("_place") + 1).cast("long")).drop("_part", "_place", "_start")
    if not keys:
        return ranked
    groups = ranked.groupBy(*keys).agg(F.min(name).alias("_first"))
    return _keyed(ranked, groups, keys).withColumn(name, F.col(name) - F.col("_first") + 1).drop("_first")


def top_fraction(df: DataFrame, column: str, fraction: float, id_col: str = "hex_id", within: list[str] | None = None) -> DataFrame:
    """The max(1, ceil(n * fraction)) best rows (of each group), ties by id."""
    keys = within or []
    limits = df.groupBy(*keys).agg(F.greatest(F.lit(1), F.ceil(F.count("*") * F.lit(fraction))).alias("_limit"))
    ranked = ordinal_ranks(df, column, id_col, "_rank", keys)
    joined = _keyed(ranked, limits, keys) if keys else ranked.join(F.broadcast(limits))
    return joined.where(F.col("_rank") <= F.col("_limit")).drop("_rank", "_limit")


def top_n(df: DataFrame, column: str, n: int, id_col: str = "hex_id") -> DataFrame:
    return df.orderBy(F.col(column).desc(), id_col).limit(n)


def best_by(df: DataFrame, key: str, order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """The n first rows of every group of ``key``, with their place; Spark limits each group before its shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col(name) <= n)


def examples(df: DataFrame, column: str, n: int, columns: list[str], ascending: bool = False, where: Column | None = None, id_col: str = "hex_id") -> DataFrame:
    """The n highest (or lowest) rows that meet a condition, with fixed columns, ties by id."""
    rows = df if where is None else df.where(where)
    order = F.col(column).asc_nulls_last() if ascending else F.col(column).desc_nulls_last()
    return rows.orderBy(order, id_col).limit(n).select(id_col, column, *columns)


def quartiles(df: DataFrame, column: str, id_col: str = "hex_id", name: str = "quartile") -> DataFrame:
    """quartile 1..4 of the ascending ordinal rank, ties by id: ceil(4 * rank / n)."""
    ranked = ordinal_ranks(df.withColumn("_neg", -F.col(column)), "_neg", id_col, "_rank").drop("_neg")
    total = df.agg(F.count("*").alias("_n"))
    return ranked.join(F.broadcast(total)).withColumn(name, F.ceil(F.lit(4.0) * F.col("_rank") / F.col("_n")).cast("int")).drop("_rank", "_n")


def leave_one_out(df: DataFrame, fields: list[str]) -> DataFrame:
    """(hex_id, omitted, score): the mean of the other fields for each field left out."""
    rows = []
    for omitted in fields:
        others = [F.col(f) for f in fields if f != omitted]
        rows.append(F.struct(F.lit(omitted).alias("omitted"), (sum(others[1:], others[0]) / F.lit(float(len(others)))).alias("score")))
    return df.select("hex_id", F.explode(F.array(*rows)).alias("o")).select("hex_id", "o.omitted", "o.score")


def stacked(df: DataFrame, columns: list[str], name: str, value: str, keep: list[str]) -> DataFrame:
    """One row for each of ``columns``: (keep, name, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_s")).select(*keep, f"_s.{name}", f"_s.{value}")
