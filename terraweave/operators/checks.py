"""Key, id, flag, range and total checks as one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_check(df: DataFrame, key: str = "hex_id", score: str | None = None) -> DataFrame:
    """One row: rows, null or empty keys, repeated keys, scores outside [0, 100]."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"), *([F.count_if(F.col(score).isNull() | F.isnan(score) | ~F.col(score).between(0, 100)).alias("bad")] if score else [F.lit(0).alias("bad")]))
    empty = F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("empty_keys"), F.count_if((F.col("n") > 1) & ~empty).alias("repeated_keys"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad_scores"))


def reconcile_ids(expected: DataFrame, found: DataFrame, key: str = "hex_id") -> DataFrame:
    """One row: counts, missing and extra ids, ids repeated on a side, and whether all agree."""
    left, right = expected.groupBy(key).agg(F.count("*").alias("a")), found.groupBy(key).agg(F.count("*").alias("b"))
    both = left.join(right, key, "full_outer")
    out = both.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("expected_rows"), F.coalesce(F.sum("b"), F.lit(0)).alias("found_rows"), F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("extra"), F.count_if((F.col("a") > 1) | (F.col("b") > 1)).alias("repeated")
    )
    return out.withColumn("exact", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("repeated") == 0))


def boolean_flag(column: Column) -> Column:
    """true/false, 1/0 in any case and spacing; anything else is null, a violation."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)


def numeric_violations(df: DataFrame, column: str, low: float | None = None, high: float | None = None, integer: bool = False) -> DataFrame:
    """One row: values that are missing, non-finite, out of range or not whole (within 1e-9)."""
    v = F.try_to_number(F.col(column), F.lit("999999999999.999999")) if dict(df.dtypes)[column] == "string" else F.col(column)
    v = v.cast("double")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    outside = F.lit(False)
    if low is not None:
        outside = outside | (v < low)
    if high is not None:
        outside = outside | (v > high)
    return df.agg(F.count("*").alias("rows"), F.count_if(~finite).alias("not_finite"), F.count_if(finite & outside).alias("out_of_range"), F.count_if(finite & F.lit(integer) & (F.abs(v - F.rint(v)) > 1e-9)).alias("not_whole"))


def one_to_one_join(base: DataFrame, other: DataFrame, fields: list[str], key: str = "hex_id") -> DataFrame:
    """Left join that fails where the other side repeats a key or misses one of the base."""
    joined = base.join(other.select(key, *fields, F.count("*").over(_by(key)).alias("_n")), key, "left")
    bad = F.col("_n").isNull() | (F.col("_n") > 1)
    checked = joined.withColumn("_ok", F.when(bad, F.raise_error(F.concat(F.lit("not one row for "), F.col(key).cast("string")))))
    return checked.where(F.col("_ok").isNull()).drop("_n", "_ok")


def _by(key: str):
    from pyspark.sql import Window

    return Window.partitionBy(key)


def flag_agreement(tables: list[DataFrame], flag: str, key: str = "hex_id") -> DataFrame:
    """One row: keys, and keys whose copies of the flag disagree or are missing."""
    copies = tables[0].select(key, flag)
    for t in tables[1:]:
        copies = copies.unionByName(t.select(key, flag))
    per_key = copies.groupBy(key).agg(F.count(flag).alias("n"), F.min(flag).alias("low"), F.max(flag).alias("high"))
    return per_key.agg(F.count("*").alias("keys"), F.count_if((F.col("n") != len(tables)) | (F.col("low") != F.col("high"))).alias("disagreeing"))


def reconcile_positions(first: DataFrame, second: DataFrame, value: str) -> DataFrame:
    """(side, positions, difference): positions on one side only, and unequal ones."""
    joined = first.select("grid_col", "grid_row", F.col(value).alias("a")).join(second.select("grid_col", "grid_row", F.col(value).alias("b")), ["grid_col", "grid_row"], "full_outer")
    side = F.when(F.col("b").isNull(), "left_only").when(F.col("a").isNull(), "right_only").when(F.col("a") == F.col("b"), "equal").otherwise("different")
    return joined.groupBy(side.alias("side")).agg(F.count("*").alias("positions"), F.sum(F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias("difference"))
