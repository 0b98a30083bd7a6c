"""Profiles, comparisons and audit tables over scores and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.operators import ranks, stats
from terraweave.operators.scoring import FIELDS

TAILS = {"top_25_percent": 0.25, "top_10_percent": 0.10, "top_5_percent": 0.05, "top_1_percent": 0.01}
PROFILE = {"median": 0.50, "p10": 0.10, "p90": 0.90}


def tail_profiles(df: DataFrame, score: str, fields: list[str], tails: dict[str, float] | None = None, id_col: str = "hex_id") -> DataFrame:
    """(tail, field, rows, median, p10, p90) inside the best fractions by ``score``; rows are ranked once."""
    total = df.agg(F.count("*").alias("_n"))
    ranked = ranks.ordinal_ranks(df.select(id_col, score, *[f for f in fields if f != score]), score, id_col, "_rank").join(F.broadcast(total))
    inside = F.array(*[F.when(F.col("_rank") <= F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(f))), name) for name, f in (tails or TAILS).items()])
    rows = ranks.stacked(ranked.withColumn("tail", F.explode(F.array_compact(inside))), fields, "field", "value", ["tail"])
    return _profiled(rows, ["tail", "field"])


def _profiled(rows: DataFrame, keys: list[str]) -> DataFrame:
    counted = rows.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counted.join(stats.percentiles(rows, keys, "value", PROFILE), keys, "left").select(*keys, "rows", *[F.round(c, 6).alias(c) for c in PROFILE])


def population_profile(df: DataFrame, population: Column, fields: list[str]) -> DataFrame:
    """(field, rows, percent, median, p10, p90) of the rows in a population, for example those that score zero."""
    whole = df.agg(F.count("*").alias("_n"))
    rows = ranks.stacked(df.where(population), fields, "field", "value", [])
    return _profiled(rows, ["field"]).join(F.broadcast(whole)).select("field", "rows", F.round(F.lit(100.0) * F.col("rows") / F.col("_n"), 6).alias("percent"), *PROFILE)


def characters(df: DataFrame, first: str, second: str, whole: str) -> DataFrame:
    """(character, rows, percent, first_sum, second_sum, first_share, second_share): which of two counts is larger.

    Shares are means of count / whole; rows with a zero whole don't take part in them.
    """
    kind = F.when(F.col(first) > F.col(second), first).when(F.col(second) > F.col(first), second).otherwise("tie")
    share = lambda c: F.round(F.avg(F.try_divide(F.col(c) * F.lit(1.0), F.col(whole))), 9)
    out = df.groupBy(kind.alias("character")).agg(F.count("*").alias("rows"), F.sum(first).alias("first_sum"), F.sum(second).alias("second_sum"), share(first).alias("first_share"), share(second).alias("second_share"))
    total = df.agg(F.count("*").alias("_n"))
    return out.join(F.broadcast(total)).select("character", "rows", F.round(F.lit(100.0) * F.col("rows") / F.col("_n"), 6).alias("percent"), "first_sum", "second_sum", "first_share", "second_share")


def subtype_shares(df: DataFrame, subtypes: list[str], whole: str) -> DataFrame:
    """(subtype, pixels, share, mean_fraction) of those subtype columns that the table has; none: no rows."""
    present = [c for c in subtypes if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "subtype string, pixels long, share double, mean_fraction double")
    rows = ranks.stacked(df, present, "subtype", "pixels", [whole])
    out = rows.groupBy("subtype").agg(F.sum("pixels").cast("long").alias("pixels"), F.round(F.avg(F.try_divide(F.col("pixels"), F.col(whole))), 9).alias("mean_fraction"))
    total = out.agg(F.sum("pixels").alias("_all"))
    return out.join(F.broadcast(total)).select("subtype", "pixels", F.try_divide(F.col("pixels") * F.lit(1.0), F.col("_all")).alias("share"), "mean_fraction")


def differences(first: DataFrame, second: DataFrame, fields: list[str], key: str = "hex_id", tolerance: float = 1e-12) -> DataFrame:
    """(field, rows, affected, median, largest, first_missing, second_missing): the same fields of two tables, row by row.

    affected: rows that differ by more than the tolerance; median and largest are taken
    over these, 0 without any.
    """
    a = ranks.stacked(first, fields, "field", "a", [key])
    b = ranks.stacked(second, fields, "field", "b", [key])
    both = a.join(b, [key, "field"]).withColumn("gap", F.abs(F.col("a") - F.col("b")))
    hit = F.col("gap") > tolerance
    out = both.groupBy("field").agg(F.count("*").alias("rows"), F.count_if(hit).alias("affected"), F.coalesce(F.max(F.when(hit, F.col("gap"))), F.lit(0.0)).alias("largest"), F.count_if(F.col("a").isNull()).alias("first_missing"), F.count_if(F.col("b").isNull()).alias("second_missing"))
    middle = stats.percentiles(both.where(hit), ["field"], "gap", {"median": 0.5})
    return out.join(middle, "field", "left").select("field", "rows", "affected", F.round(F.coalesce("median", F.lit(0.0)), 9).alias("median"), F.round("largest", 9).alias("largest"), "first_missing", "second_missing")


def rank_differences(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: how the rank fractions of two fields differ."""
    ranked = ranks.rank_fraction(ranks.rank_fraction(df, a, "_a"), b, "_b").withColumn("gap", F.abs(F.col("_b") - F.col("_a")))
    points = stats.percentiles(ranked, [], "gap", {"median": 0.5, "p90": 0.9})
    out = ranked.agg(F.count("*").alias("rows"), F.round(F.max("gap"), 9).alias("largest"), F.count_if(F.col("gap") >= 0.10).alias("at_least_10"), F.count_if(F.col("gap") >= 0.25).alias("at_least_25"), F.round(stats.guarded_corr(F.col("_a"), F.col("_b")), 6).alias("spearman"))
    return out.join(F.broadcast(points.select(*[F.round(c, 9).alias(c) for c in ("median", "p90")])))


def tradeoff(df: DataFrame, several: list[str] | None = None, other: str = FIELDS[4]) -> DataFrame:
    """(quartile, rows, other_median, mean_median, both_high, high_low, low_high, correlation): the mean of several fields against another.

    Quartiles are those of the mean; the counts take 75 as high and 25 as low.
    """
    several = several or FIELDS[:4]
    columns = [F.col(c) for c in several]
    rows = df.select("hex_id", (sum(columns[1:], columns[0]) / F.lit(float(len(columns)))).alias("mean"), F.col(other).alias("other"))
    dealt = ranks.quartiles(rows.withColumn("mean", F.round("mean", 9)), "mean")
    high, low = (F.col("mean") >= 75, F.col("other") >= 75), (F.col("mean") <= 25, F.col("other") <= 25)
    counted = dealt.groupBy("quartile").agg(F.count("*").alias("rows"), F.count_if(high[0] & high[1]).alias("both_high"), F.count_if(high[0] & low[1]).alias("high_low"), F.count_if(low[0] & high[1]).alias("low_high"))
    medians = [stats.percentiles(dealt, ["quartile"], c, {f"{c}_median": 0.5}) for c in ("other", "mean")]
    whole = dealt.agg(F.round(stats.guarded_corr(F.col("mean"), F.col("other")), 6).alias("correlation"))
    return counted.join(medians[0], "quartile").join(medians[1], "quartile").join(F.broadcast(whole))


def quartile_correlations(df: DataFrame, by: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """(quartile, rows, least, most, a, b, value): correlations inside the quartiles of ``by``."""
    dealt = ranks.quartiles(df, by)
    wide = dealt.groupBy("quartile").agg(F.count("*").alias("rows"), F.min(by).alias("least"), F.max(by).alias("most"), *[F.round(stats.guarded_corr(F.col(a), F.col(b)), 6).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("value")) for i, (a, b) in enumerate(pairs)])
    return wide.select("quartile", "rows", "least", "most", F.explode(cells).alias("c")).select("quartile", "rows", "least", "most", "c.*")


def reproduction(now: DataFrame, before: DataFrame, fields: dict[str, str], flag: str, key: str = "hex_id", tolerance: float = 1e-10) -> DataFrame:
    """(field, rows, largest, mismatches, flag_mismatches): scores against those of an earlier run, by id."""
    old = before.select(key, *[F.col(b).alias(f"_b_{a}") for a, b in fields.items()], F.col(flag).alias("_flag"))
    gaps = F.array(*[F.struct(F.lit(a).alias("field"), F.abs(F.col(a) - F.col(f"_b_{a}")).alias("gap")) for a in fields])
    joined = now.join(old, key, "left").select(F.explode(gaps).alias("g"), (~F.col(flag).eqNullSafe(F.col("_flag"))).alias("other_flag"))
    return joined.groupBy("g.field").agg(F.count("*").alias("rows"), F.max("g.gap").alias("largest"), F.count_if(F.col("g.gap").isNull() | (F.col("g.gap") > tolerance)).alias("mismatches"), F.count_if("other_flag").alias("flag_mismatches"))


def score_audit(df: DataFrame, score: str, contributions: dict[str, str]) -> DataFrame:
    """(component, correlation, spread, covariance, least, most, formula_gap): a score against the parts that add up to it."""
    total = sum((F.col(c) for c in list(contributions.values())[1:]), F.col(next(iter(contributions.values()))))
    aggregates = [F.max(F.abs(F.col(score) - total)).alias("gap")]
    for i, (field, part) in enumerate(contributions.items()):
        aggregates += [stats.guarded_corr(F.col(score), F.col(field)).alias(f"r{i}"), F.stddev_pop(part).alias(f"s{i}"), F.covar_pop(part, score).alias(f"v{i}"), F.min(part).alias(f"l{i}"), F.max(part).alias(f"m{i}")]
    wide = df.agg(*aggregates)
    rows = F.array(
        *[
            F.struct(F.lit(f).alias("component"), *[F.round(F.col(f"{k}{i}"), 6).alias(name) for k, name in (("r", "correlation"), ("s", "spread"), ("v", "covariance"), ("l", "least"), ("m", "most"))], (F.col("gap") <= 1e-9).alias("formula_holds"))
            for i, f in enumerate(contributions)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def preset_comparisons(df: DataFrame, reference: str, presets: list[str], other: str = FIELDS[4]) -> DataFrame:
    """(preset, spearman, overlap, other_correlation, other_median): every preset against the reference.

    overlap: ids that the best tenths share; other_median: of ``other`` in the preset's best tenth.
    """
    every = ranks.stacked(df, presets, "preset", "score", ["hex_id", other])
    ranked = ranks.average_ranks(every, "score", within=["preset"]).drop("n")
    base = ranked.where(F.col("preset") == reference).select("hex_id", F.col("rank_avg").alias("_rank"))
    agreement = ranked.join(base, "hex_id").groupBy("preset").agg(F.round(stats.guarded_corr(F.col("rank_avg"), F.col("_rank")), 6).alias("spearman"), F.round(stats.guarded_corr(F.col("score"), F.col(other)), 6).alias("other_correlation"))
    tails = ranks.top_fraction(every, "score", 0.1, within=["preset"])
    top = tails.where(F.col("preset") == reference).select("hex_id", F.lit(1).alias("_in"))
    overlap = tails.join(top, "hex_id", "left").groupBy("preset").agg(F.count("_in").alias("overlap"))
    return agreement.join(overlap, "preset").join(stats.percentiles(tails, ["preset"], other, {"other_median": 0.5}), "preset")


def churn_profiles(df: DataFrame, reference: str, schemes: list[str], fields: list[str], n: int = 100) -> DataFrame:
    """(scheme, change, field, rows, median, p10, p90): rows that enter or leave the best n of each scheme against the reference."""
    every = ranks.stacked(df, [reference, *schemes], "scheme", "score", ["hex_id"])
    best = ranks.best_by(every, "scheme", [F.col("score").desc(), F.col("hex_id")], n).select("scheme", "hex_id")
    base = best.where(F.col("scheme") == reference).select("hex_id")
    expected = base.withColumn("scheme", F.explode(F.array(*[F.lit(s) for s in schemes])))
    now = best.where(F.col("scheme") != reference)
    moved = now.join(base, "hex_id", "left_anti").withColumn("change", F.lit("entered")).unionByName(expected.join(now, ["scheme", "hex_id"], "left_anti").withColumn("change", F.lit("left")))
    rows = ranks.stacked(moved.join(df.select("hex_id", *fields), "hex_id"), fields, "field", "value", ["scheme", "change"])
    return _profiled(rows, ["scheme", "change", "field"])
