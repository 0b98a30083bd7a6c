"""Land-cover classes: code to group, roles over groups, checks and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The codes of each factual group.
GROUP_CODES: dict[str, tuple[int, ...]] = {
    "no_data": (0,),
    "arable": (3,),
    "artificial_building": (51,),
    "artificial_other": (52,),
    "artificial_transport": (53,),
    "peat_extraction": (54,),
    "inland_water": (61,),
    "sea": (62,),
    "established_forest_firm_ground": (111, 112, 113, 114, 115, 116, 117),
    "transitional_forest_firm_ground": (118,),
    "established_forest_wetland": (121, 122, 123, 124, 125, 126, 127),
    "transitional_forest_wetland": (128,),
    "open_wetland": (200, 211, 212, 213, 214, 215, 216, 217, 218, 221, 222, 223, 224, 225, 226, 227, 228),
    "open_nonvegetated": (411,),
    "open_vegetated": (4211, 4212, 4213, 4221, 4222, 4223, 4231, 4232, 4233),
}
# The groups of each analytical role.
ROLE_GROUPS: dict[str, tuple[str, ...]] = {
    "primary_candidate": ("arable",),
    "habitat_context_proxy": ("established_forest_firm_ground", "established_forest_wetland", "open_wetland", "open_vegetated"),
    "wetland_context": ("established_forest_wetland", "transitional_forest_wetland", "open_wetland"),
    "inland_water_context": ("inland_water",),
    "artificial_constraint": ("artificial_building", "artificial_other", "artificial_transport"),
    "transitional_forest": ("transitional_forest_firm_ground", "transitional_forest_wetland"),
    "terrestrial_land": tuple(g for g in GROUP_CODES if g not in ("no_data", "inland_water", "sea")),
}


def class_dimension(spark: SparkSession) -> DataFrame:
    """(code, group, roles): 51 rows, whatever the data, so it is always broadcast."""
    rows = [(code, group, [r for r, groups in ROLE_GROUPS.items() if group in groups]) for group, codes in GROUP_CODES.items() for code in codes]
    return spark.createDataFrame(rows, "code int, group string, roles array<string>")


def with_classes(pixels: DataFrame) -> DataFrame:
    """Known codes only, with group and roles; see ``unknown_codes`` for the others."""
    return pixels.join(F.broadcast(class_dimension(pixels.sparkSession)), "code")


def unknown_codes(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("code").count().join(F.broadcast(class_dimension(pixels.sparkSession)), "code", "left_anti")


def with_masks(pixels: DataFrame) -> DataFrame:
    """One boolean column for each role."""
    classed = with_classes(pixels)
    return classed.withColumns({role: F.array_contains("roles", role) for role in ROLE_GROUPS})


def class_audit(pixels: DataFrame, pixel_area_m2: float = 100.0) -> DataFrame:
    """(level, name, pixels, area_km2, percent_of_valid) for codes, groups and roles.

    Pixels are counted once by code; groups and roles roll up the at most 51 counts.
    """
    counts = with_classes(pixels.groupBy("code").agg(F.count("*").alias("pixels")))
    levels = [("code", F.col("code").cast("string"), counts), ("group", F.col("group"), counts), ("role", F.col("role"), counts.withColumn("role", F.explode("roles")))]
    parts = [df.groupBy(F.lit(level).alias("level"), name.alias("name")).agg(F.sum("pixels").alias("pixels")) for level, name, df in levels]
    total = counts.where("code <> 0").agg(F.sum("pixels").alias("valid"))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).join(F.broadcast(total))
    return every.select("level", "name", "pixels", (F.col("pixels") * F.lit(pixel_area_m2 / 1e6)).alias("area_km2"), F.try_divide(F.lit(100.0) * F.col("pixels"), F.col("valid")).alias("percent_of_valid"))


def role_overlaps(pixels: DataFrame) -> DataFrame:
    """(role_a, role_b, pixels) for pairs of roles that share codes."""
    counts = with_classes(pixels.groupBy("code").agg(F.count("*").alias("pixels")))
    pairs = counts.select("pixels", F.explode("roles").alias("role_a"), "roles").withColumn("role_b", F.explode("roles")).where("role_a < role_b")
    return pairs.groupBy("role_a", "role_b").agg(F.sum("pixels").alias("pixels"))
