"""Component score tables, their reconciliation, and the delivered frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import checks, delivery, ranks
from terraweave.operators.scoring import FIELDS, PRESETS, weighted_mean

FLAG = "boundary_edge_flag"
#: Raw field and further fields that each component's table carries, in the order of FIELDS.
EVIDENCE = {
    FIELDS[0]: ("habitat_local_fraction", ()), FIELDS[1]: ("opposing_balance_ratio", ()), FIELDS[2]: ("riparian_focal_fraction", ()),
    FIELDS[3]: ("nearest_protected_hex_steps", ("protected_focal_fraction",)), FIELDS[4]: ("candidate_land_area_ha", ("artificial_focal_fraction",)),
}
# Decimals of the delivered fields.
DECIMALS = {"score": 3, "fraction": 5, "hectares": 2, "degrees": 6}


def direct_scale(ratio: Column) -> Column:
    """100 * ratio; a ratio outside [0, 1] is an error, a missing one stays missing."""
    bad = ratio.isNotNull() & (F.isnan(ratio) | (ratio < 0) | (ratio > 1))
    return F.when(bad, F.raise_error(F.concat(F.lit("ratio outside [0, 1]: "), ratio.cast("string"))).cast("double")).otherwise(F.lit(100.0) * ratio)


def component(indicators: DataFrame, flags: DataFrame, field: str) -> DataFrame:
    """(hex_id, raw field, score, further fields, boundary_edge_flag) of one component, one row a candidate.

    Habitat context and land score by percentile, the network directly, riparian
    opportunity by percentile of the positive values, protection by reversed steps.
    """
    raw, more = EVIDENCE[field]
    rows = checks.one_to_one_join(indicators.select("hex_id", raw, *more), flags, [FLAG])
    if field == FIELDS[1]:
        scored = rows.withColumn(field, direct_scale(F.col(raw)))
    else:
        by = {FIELDS[2]: ranks.positive_percentile_score, FIELDS[3]: ranks.reverse_score}.get(field, ranks.percentile_score)
        scored = by(rows, raw, field)
    return scored.select("hex_id", raw, field, *more, FLAG)


def reconcile(candidates: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Candidates with all component fields; an id that is missing, repeated or flagged differently is an error."""
    out = candidates
    for i, (field, (raw, more)) in enumerate(EVIDENCE.items()):
        flag = f"_flag_{i}"
        out = checks.one_to_one_join(out, tables[field].withColumnRenamed(FLAG, flag), [raw, field, *more, flag])
    flags = [F.col(f"_flag_{i}") for i in range(len(EVIDENCE))]
    same = F.least(*flags).eqNullSafe(F.greatest(*flags)) & F.forall(F.array(*flags), lambda x: x.isNotNull())
    checked = F.when(same, flags[0]).otherwise(F.raise_error(F.concat(F.lit("boundary flags disagree for "), F.col("hex_id"))).cast("boolean"))
    return out.withColumn(FLAG, checked).drop(*[f"_flag_{i}" for i in range(len(EVIDENCE))])


def centroid(frame: DataFrame) -> tuple[Column, Column]:
    return delivery.lon_lat(*hexgrid.centre(F.col("grid_col"), F.col("grid_row")), DECIMALS["degrees"])


def weight_index(frame: DataFrame) -> DataFrame:
    """(hex_id, longitude, latitude, five rounded scores) for weighting by the user."""
    lon, lat = centroid(frame)
    score = delivery.exact_round(DECIMALS["score"])
    return frame.select("hex_id", lon.alias("longitude"), lat.alias("latitude"), *[score(F.col(f)).alias(f) for f in FIELDS])


def delivery_frame(frame: DataFrame) -> DataFrame:
    """The 17 delivered fields, rounded: id, presets, components, their evidence, flag."""
    score, fraction, hectares = (delivery.exact_round(DECIMALS[k]) for k in ("score", "fraction", "hectares"))
    presets = [score(weighted_mean(w)).alias(name) for name, w in PRESETS.items()]
    evidence = [F.col(c).cast("int").alias(c) if c.endswith("_steps") else (hectares if c.endswith("_ha") else fraction)(F.col(c)).alias(c) for raw, more in EVIDENCE.values() for c in (raw, *more)]
    return frame.select("hex_id", *presets, *[score(F.col(f)).alias(f) for f in FIELDS], *evidence, FLAG)


def bounds_check(points: DataFrame, low: tuple[float, float] = (11.0, 54.5), high: tuple[float, float] = (15.5, 57.5)) -> DataFrame:
    """One row: extent of longitude and latitude, points outside the limits or without a place."""
    lon, lat = F.col("longitude"), F.col("latitude")
    inside = F.coalesce(lon.between(low[0], high[0]) & lat.between(low[1], high[1]), F.lit(False))
    return points.agg(F.min(lon).alias("min_longitude"), F.max(lon).alias("max_longitude"), F.min(lat).alias("min_latitude"), F.max(lat).alias("max_latitude"), F.count_if(~inside).alias("outside"))
