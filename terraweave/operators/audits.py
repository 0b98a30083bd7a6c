"""Pairs of similar rows, movers between two scores, effects of schemes, and delivery audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.operators import delivery, ranks, raster, stats


def is_current(version: Column, major: int = 2) -> Column:
    """Whether the version text counts as current: its first number, read up to a separator, is the major one.

    "v2.1", "NMD version 2", "2x" and "2-3" count; "v1.2", "12", "v20" and a text without a
    number don't. Null: null.
    """
    number = F.regexp_extract(version, r"([0-9]+)", 1)
    return F.when(version.isNotNull(), F.coalesce(F.try_to_number(F.when(number != "", number), F.lit("999999999")) == major, F.lit(False)))


def coverage(pixels: DataFrame, edges: DataFrame, marine: tuple[int, ...] = (61, 62), pixel_m2: float = 100.0) -> DataFrame:
    """One row: valid, marine and land pixels, and those outside all polygons of a current version.

    edges: (feature_id, version, x1, y1, x2, y2). Codes are counted twice, before and after
    clipping, and meet as one row a code. No current polygon: nothing is covered.
    """
    current = raster.spans(edges.where(is_current(F.col("version"))))
    tagged = pixels.select("code", F.lit(0).alias("inside")).unionByName(raster.clip_to_spans(pixels, current).select("code", F.lit(1).alias("inside")))
    by_code = tagged.groupBy("code").agg(F.count_if(F.col("inside") == 0).alias("n"), F.count_if(F.col("inside") == 1).alias("covered"))
    sea, open_ = F.col("code").isin(*marine), F.col("n") - F.col("covered")
    total = lambda v: F.coalesce(F.sum(v), F.lit(0)).cast("long")
    out = by_code.agg(total(F.col("n")).alias("valid_pixels"), total(F.when(sea, F.col("n"))).alias("marine_pixels"), total(F.when(~sea, F.col("n"))).alias("land_pixels"), total(F.when(sea, open_)).alias("uncovered_marine"), total(F.when(~sea, open_)).alias("uncovered_land"))
    return out.withColumn("uncovered_land_m2", F.col("uncovered_land") * F.lit(pixel_m2)).withColumn("complete", F.col("uncovered_land") == 0)


def adjacent_pairs(df: DataFrame, score: str, values: list[str], tolerance: float = 0.5, n: int = 3, id_col: str = "hex_id") -> DataFrame:
    """(field, place, first_id, second_id, gap, difference): the n largest differences of each field.

    Pairs are neighbours in (score, id) order with a gap of at most ``tolerance``; neighbours
    meet by an equality join on exact ranks. Ties go to the earlier pair. Null scores take no part.
    """
    rows = df.where(F.col(score).isNotNull()).select(id_col, F.col(score).alias("_s"), (-F.col(score)).alias("_down"), *values)
    placed = ranks.ordinal_ranks(rows, "_down", id_col, "_rank")
    after = placed.select((F.col("_rank") - 1).alias("_rank"), F.col(id_col).alias("second_id"), F.col("_s").alias("_s2"), *[F.col(v).alias(f"_{v}") for v in values])
    pairs = placed.join(after, "_rank").withColumn("gap", F.abs(F.col("_s2") - F.col("_s"))).where(F.col("gap") <= tolerance)
    changes = F.array(*[F.struct(F.lit(v).alias("field"), F.abs(F.col(v) - F.col(f"_{v}")).alias("difference")) for v in values])
    rows = pairs.select("_rank", F.col(id_col).alias("first_id"), "second_id", "gap", F.explode(changes).alias("c")).select("c.field", "_rank", "first_id", "second_id", "gap", "c.difference").where("difference is not null")
    return ranks.best_by(rows, "field", [F.desc("difference"), F.col("_rank")], n, "place").select("field", "place", "first_id", "second_id", "gap", "difference")


def extreme_movers(df: DataFrame, reference: str, schemes: list[str], n: int = 10, id_col: str = "hex_id") -> DataFrame:
    """(scheme, direction, place, id, movement, reference_rank, scheme_rank): the n largest moves of percentile rank each way."""
    every = ranks.stacked(df, [reference, *schemes], "scheme", "value", [id_col])
    ranked = ranks.ordinal_ranks(ranks.percentile_score(every, "value", "percentile", within=["scheme"]), "value", id_col, "scheme_rank", ["scheme"])
    base = ranked.where(F.col("scheme") == reference).select(id_col, F.col("percentile").alias("_from"), F.col("scheme_rank").alias("reference_rank"))
    moved = ranked.where(F.col("scheme") != reference).join(base, id_col).withColumn("movement", F.round(F.col("percentile") - F.col("_from"), 9)).where("movement is not null")
    both = moved.withColumn("direction", F.explode(F.array(F.lit("upward"), F.lit("downward"))))
    signed = F.when(F.col("direction") == "upward", -F.col("movement")).otherwise(F.col("movement"))
    keyed = both.withColumn("_list", F.concat_ws("/", "scheme", "direction"))
    return ranks.best_by(keyed, "_list", [signed, F.col(id_col)], n, "place").select("scheme", "direction", id_col, "movement", "reference_rank", "scheme_rank", "place")


def thematic_effect(df: DataFrame, reference: str, schemes: list[str], field: str, threshold: float, fraction: float = 0.1) -> DataFrame:
    """(scheme, rows, median, change, at_threshold) of ``field`` in the best ``fraction`` of each scheme.

    change: median less that of the reference's tail. The reference has its own row, change 0.
    """
    every = ranks.stacked(df, [reference, *schemes], "scheme", "value", ["hex_id", field])
    tails = ranks.top_fraction(every, "value", fraction, within=["scheme"])
    counted = tails.groupBy("scheme").agg(F.count("*").alias("rows"), F.count_if(F.col(field) >= threshold).alias("at_threshold"))
    profile = counted.join(stats.percentiles(tails, ["scheme"], field, {"median": 0.5}), "scheme")
    # one row a scheme
    base = F.max(F.when(F.col("scheme") == reference, F.col("median"))).over(ranks.Window.partitionBy(F.lit(0)))
    return profile.withColumn("change", F.col("median") - base)


def rounding_audit(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """(field, decimals, max_difference, mismatches): full values against delivered ones, ``<field>_delivered``."""
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(d).alias("decimals"), F.col(f).alias("full"), delivery.exact_round(d)(F.col(f)).alias("expected"), F.col(f"{f}_delivered").alias("delivered")) for f, d in digits.items()])
    each = df.select(F.explode(rows).alias("r")).select("r.*")
    return each.groupBy("field", "decimals").agg(F.max(F.abs(F.col("full") - F.col("expected"))).alias("max_difference"), F.count_if(~F.col("expected").eqNullSafe(F.col("delivered"))).alias("mismatches"))


def payload(features: DataFrame) -> DataFrame:
    """One row: features, bytes of their texts, and bytes of geometry alone."""
    geometry = F.octet_length(F.get_json_object("feature", "$.geometry"))
    size = F.octet_length("feature")
    return features.agg(F.count("*").alias("features"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.coalesce(F.sum(geometry), F.lit(0)).alias("geometry_bytes"), F.coalesce(F.max(size), F.lit(0)).cast("long").alias("largest"))
