"""Pixels to cells: compositions, hydrology, protection and eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators.semantics import GROUP_CODES, ROLE_GROUPS

PIXEL_M2 = 100.0
CELL_M2 = hexgrid.WIDTH * hexgrid.WIDTH * 3**0.5 / 2


def codes_of(role: str) -> list[int]:
    return [code for group in ROLE_GROUPS[role] for code in GROUP_CODES[group]]


def has_role(role: str) -> Column:
    return F.col("code").isin(codes_of(role))


def composition(pixels: DataFrame, footprint: DataFrame | None = None) -> DataFrame:
    """Ten counts a cell over valid pixels (grid_col, grid_row, code): one partial and one final aggregate.

    No join with the class table: roles become constant code sets inside the aggregate.
    footprint: whole runs (px_row, left, right); with them protected_pixels, the terrestrial ones inside, come from the same pass,
    as they do from pixels with a column ``protected``.
    """
    roles = {
        "terrestrial_pixels": "terrestrial_land", "candidate_pixels": "primary_candidate", "habitat_context_pixels": "habitat_context_proxy",
        "wetland_context_pixels": "wetland_context", "inland_water_pixels": "inland_water_context", "artificial_pixels": "artificial_constraint", "transitional_pixels": "transitional_forest",
    }
    counts = [F.count("*").alias("valid_pixels"), *[F.count_if(has_role(r)).alias(c) for c, r in roles.items()]]
    counts += [F.count_if(F.col("code") == 54).alias("peat_pixels"), F.count_if(F.col("code") == 62).alias("sea_pixels")]
    if footprint is not None:
        pixels = _marked(pixels, footprint)
    if "protected" in pixels.columns:
        counts.append(F.count_if(has_role("terrestrial_land") & F.col("protected")).alias("protected_pixels"))
    return pixels.groupBy("grid_col", "grid_row").agg(*counts)


def analysis_units(counts: DataFrame) -> DataFrame:
    """Terrestrial cells with id, areas and fractions; fractions are not clamped."""
    f = lambda a, b: F.try_divide(F.col(a) * F.lit(1.0), F.col(b))
    return counts.where("terrestrial_pixels > 0").select(
        hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")).alias("hex_id"), *counts.columns, (F.col("terrestrial_pixels") * PIXEL_M2).alias("terrestrial_area_m2"), (F.col("candidate_pixels") * PIXEL_M2).alias("candidate_area_m2"),
        (F.col("terrestrial_pixels") * PIXEL_M2 / F.lit(CELL_M2)).alias("terrestrial_fraction"), f("candidate_pixels", "terrestrial_pixels").alias("candidate_fraction_of_terrestrial"), f("habitat_context_pixels", "terrestrial_pixels").alias("habitat_fraction_of_terrestrial"),
    )


def is_eligible(min_area_m2: float = 50_000.0, min_fraction: float = 0.25) -> Column:
    """The limits of ``eligible`` on cell counts; false for cells without land."""
    area, fraction = F.col("candidate_pixels") * PIXEL_M2, F.try_divide(F.col("candidate_pixels") * F.lit(1.0), F.col("terrestrial_pixels"))
    return F.coalesce((area >= min_area_m2) & (fraction >= min_fraction), F.lit(False))


def eligible(units: DataFrame, min_area_m2: float = 50_000.0, min_fraction: float = 0.25) -> DataFrame:
    """Candidates: both limits are inclusive."""
    return units.where((F.col("candidate_area_m2") >= min_area_m2) & (F.col("candidate_fraction_of_terrestrial") >= min_fraction))


def eligibility_diagnostics(units: DataFrame, min_area_m2: float = 50_000.0, min_fraction: float = 0.25) -> DataFrame:
    """(outcome, cells, candidate_area_m2): pass, area only, fraction only or both failed."""
    area, fraction = F.col("candidate_area_m2") >= min_area_m2, F.col("candidate_fraction_of_terrestrial") >= min_fraction
    outcome = F.when(area & fraction, "pass").when(fraction, "area_only").when(area, "fraction_only").otherwise("both")
    return units.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("cells"), F.sum("candidate_area_m2").alias("candidate_area_m2"))


def hydrology(counts: DataFrame, *more: Column) -> DataFrame:
    """Seven counts on every valid position, cells of water alone included; more: further columns from the counts."""
    wet, water = F.col("wetland_context_pixels"), F.col("inland_water_pixels")
    return counts.select(
        "grid_col", "grid_row", "valid_pixels", "terrestrial_pixels", wet.alias("wetland_pixels"), water.alias("water_pixels"), (wet + water).alias("hydrologic_pixels"), (F.col("terrestrial_pixels") + water).alias("nonmarine_pixels"), "sea_pixels", *more
    )


def _marked(pixels: DataFrame, footprint: DataFrame) -> DataFrame:
    """``pixels`` with protected: whether a run of the footprint holds them."""
    mask = footprint.select(F.col("px_row").alias("_row"), F.col("left").alias("_left"), F.col("right").alias("_right"))
    return pixels.join(mask, (F.col("px_row") == F.col("_row")) & F.col("px_col").between(F.col("_left"), F.col("_right")), "left").withColumn("protected", F.col("_row").isNotNull())


def protection(pixels: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Terrestrial and protected terrestrial pixels a cell; runs: merged runs of the footprint (px_row, left, right).

    A pixel meets at most one merged run, by an equality on the row and a range test. Without runs the pixels have a column ``protected``.
    """
    land = pixels.where(has_role("terrestrial_land"))
    marked = land if runs is None else _marked(land, runs)
    return with_protected_fraction(marked.groupBy("grid_col", "grid_row").agg(F.count("*").alias("terrestrial_pixels"), F.count_if("protected").alias("protected_pixels")))


def with_protected_fraction(counts: DataFrame) -> DataFrame:
    return counts.withColumn("protected_fraction", F.try_divide(F.col("protected_pixels") * F.lit(1.0), F.col("terrestrial_pixels")))


def protected_of(counts: DataFrame) -> DataFrame:
    """The table of ``protection`` from cell counts that hold protected_pixels."""
    return with_protected_fraction(counts.where("terrestrial_pixels > 0").select("grid_col", "grid_row", "terrestrial_pixels", "protected_pixels"))
