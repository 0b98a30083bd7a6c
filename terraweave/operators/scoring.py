"""Component scores, presets, sensitivity schemes, custom weights and their audits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.operators import ranks

FIELDS = ["habitat_context_score", "ecological_network_score", "riparian_opportunity_score", "protected_area_reinforcement_score", "restoration_land_availability_score"]
# Weights in the order of FIELDS.
PRESETS = {"balanced": (0.20, 0.20, 0.20, 0.20, 0.20), "connectivity_first": (0.20, 0.30, 0.10, 0.25, 0.15), "riparian_restoration": (0.20, 0.10, 0.35, 0.15, 0.20)}
SCHEMES = {
    "connectivity_mild": (0.20, 0.25, 0.15, 0.25, 0.15), "connectivity_medium": (0.20, 0.30, 0.10, 0.25, 0.15), "connectivity_strong": (0.20, 0.35, 0.10, 0.25, 0.10),
    "riparian_mild": (0.20, 0.15, 0.30, 0.15, 0.20), "riparian_medium": (0.20, 0.10, 0.35, 0.15, 0.20), "riparian_strong": (0.15, 0.10, 0.40, 0.15, 0.20),
}


def check_weights(weights: tuple[float, ...]) -> None:
    if len(weights) != len(FIELDS) or not all(math.isfinite(w) and w >= 0 for w in weights) or abs(sum(weights) - 1) > 1e-10:
        raise ValueError(f"weights must be {len(FIELDS)} finite numbers >= 0 that sum to 1: {weights}")


def weighted_mean(weights: tuple[float, ...]) -> Column:
    """Sum of weight * score from left to right in the order of FIELDS."""
    check_weights(weights)
    out = F.lit(weights[0]) * F.col(FIELDS[0])
    for w, f in zip(weights[1:], FIELDS[1:], strict=True):
        out = out + F.lit(w) * F.col(f)
    return out


def with_schemes(scores: DataFrame, schemes: dict[str, tuple[float, ...]]) -> DataFrame:
    return scores.select("hex_id", *[weighted_mean(w).alias(name) for name, w in schemes.items()])


def baseline(scores: DataFrame) -> DataFrame:
    parts = [(F.lit(0.2) * F.col(f)).alias(f"contribution_{f.removesuffix('_score')}") for f in FIELDS]
    return scores.select("hex_id", *parts, weighted_mean(PRESETS["balanced"]).alias("balanced"))


def custom_rank(scores: DataFrame, raw_weights: dict[str, tuple[float, ...]], n: int = 5) -> DataFrame:
    """(vector, rank, hex_id, score): the best n for each named vector of raw weights, in one pass.

    Raw weights are divided by their sum; all zero means equal weights.
    """
    columns = {}
    for name, raw in raw_weights.items():
        total = sum(raw)
        weights = [w / total for w in raw] if total > 0 else [0.2] * len(FIELDS)
        score = F.col(FIELDS[0]) * F.lit(weights[0])
        for w, f in zip(weights[1:], FIELDS[1:], strict=True):
            score = score + F.col(f) * F.lit(w)
        columns[name] = score
    rows = ranks.stacked(scores.select("hex_id", *[c.alias(name) for name, c in columns.items()]), list(columns), "vector", "score", ["hex_id"])
    return ranks.best_by(rows, "vector", [F.col("score").desc(), F.col("hex_id")], n)


def compensability(top: DataFrame) -> DataFrame:
    """One row: how often a high score hides weak components."""
    weak = sum(((F.col(f) <= 25).cast("int") for f in FIELDS[1:]), (F.col(FIELDS[0]) <= 25).cast("int"))
    least = F.least(*FIELDS)
    return top.agg(F.count("*").alias("rows"), F.count_if(weak >= 1).alias("any_at_most_25"), F.count_if(least == 0).alias("any_zero"), F.count_if(weak >= 2).alias("two_at_most_25"), F.min(least).alias("least_component"))


def consistent_strength(scores: DataFrame, limits: tuple[int, ...] = (50, 60, 75)) -> DataFrame:
    least = F.least(*FIELDS)
    return scores.agg(*[F.count_if(least >= t).alias(f"all_at_least_{t}") for t in limits])


def component_winners(scores: DataFrame) -> DataFrame:
    """(winner, rows, tied_rows): the strongest component of each row, the first on ties."""
    best = F.greatest(*FIELDS)
    winner = F.when(F.lit(False), "")
    for f in FIELDS:
        winner = winner.when(F.col(f) == best, f)
    ties = sum(((F.col(f) == best).cast("int") for f in FIELDS[1:]), (F.col(FIELDS[0]) == best).cast("int"))
    return scores.select(winner.alias("winner"), ties.alias("ties")).groupBy("winner").agg(F.count("*").alias("rows"), F.count_if(F.col("ties") > 1).alias("tied_rows"))


def preset_winners(presets: DataFrame) -> DataFrame:
    """(pattern, rows): which presets share a row's highest score, joined by '+'."""
    names = list(PRESETS)
    best = F.greatest(*names)
    return presets.groupBy(F.concat_ws("+", *[F.when(F.col(n) == best, n) for n in names]).alias("pattern")).agg(F.count("*").alias("rows"))


def contribution_spread(scores: DataFrame, schemes: dict[str, tuple[float, ...]]) -> DataFrame:
    """(scheme, field, spread): population deviation of weight * score."""
    cells = [F.struct(F.lit(s).alias("scheme"), F.lit(f).alias("field"), F.lit(w).alias("w")) for s, weights in schemes.items() for f, w in zip(FIELDS, weights, strict=True)]
    spread = scores.agg(*[F.stddev_pop(f).alias(f) for f in FIELDS])
    value = F.when(F.lit(False), 0.0)
    for f in FIELDS:
        value = value.when(F.col("c.field") == f, F.col(f))
    return spread.withColumn("c", F.explode(F.array(*cells))).select("c.scheme", "c.field", F.round(F.col("c.w") * value, 6).alias("spread"))


# What is said of each component by band.
PHRASES = {
    "habitat_context_score": ("Strong surrounding habitat context.", "Moderate surrounding habitat context.", "Weaker surrounding habitat context."),
    "ecological_network_score": ("Strong opposing-side habitat configuration, suggesting potential to reinforce ecological structure.", "Moderate opposing-side habitat configuration.", "Weaker opposing-side habitat configuration."),
    "riparian_opportunity_score": ("Strong mapped focal wetland and inland-water context.", "Moderate mapped focal wetland and inland-water context.", "Little or no mapped focal wetland and inland-water context."),
    "protected_area_reinforcement_score": ("Close to the existing terrestrial protected-area network.", "Moderate proximity to the existing terrestrial protected-area network.", "More limited proximity to the existing terrestrial protected-area network."),
    "restoration_land_availability_score": ("Relatively large amount of mapped candidate arable land.", "Moderate amount of mapped candidate arable land.", "Available candidate land is relatively limited within this analysis unit."),
}


def explain(scores: DataFrame) -> DataFrame:
    """(hex_id, explanation): the two highest components in words, then one caveat, at most three.

    Equal components keep the order of FIELDS.
    """
    items = F.array(*[F.struct((-F.col(f)).alias("key"), F.lit(i).alias("i"), F.when(F.col(f) >= 75, s).when(F.col(f) >= 50, m).otherwise(w).alias("say")) for i, (f, (s, m, w)) in enumerate(PHRASES.items())])
    two = F.transform(F.slice(F.array_sort(items), 1, 2), lambda x: x["say"])
    caveat = F.when(F.col(FIELDS[4]) < 50, F.array(F.lit(PHRASES[FIELDS[4]][2]))).when(F.col(FIELDS[2]) < 50, F.array(F.lit(PHRASES[FIELDS[2]][2]))).otherwise(F.array().cast("array<string>"))
    return scores.select("hex_id", F.array_join(F.slice(F.array_distinct(F.concat(two, caveat)), 1, 3), " ").alias("explanation"))
