"""Checks and readers of polygon layers, component tables and the hexagon grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import cells, checks, runs, stats


def require_columns(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{label} lacks {', '.join(missing)}")
    return df


def read_component(spark: SparkSession, path: str, columns: dict[str, str], score: str, key: str = "hex_id", source: str = "parquet") -> DataFrame:
    """A component table as Parquet or CSV with exactly the columns asked for (name: type), refused if it is bad.

    Refused are tables that lack a column, hold no rows, empty or repeated keys, or scores
    that are missing or outside [0, 100].
    """
    if source == "csv":
        names = spark.read.option("header", True).csv(path).columns
        df = spark.read.option("header", True).schema(", ".join(f"`{c}` {columns.get(c, 'string')}" for c in names)).csv(path)
    else:
        df = spark.read.parquet(path)
    df = require_columns(df, list(columns), path).select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])
    found = checks.key_check(df, key, score).first()
    if not found["rows"] or found["empty_keys"] or found["repeated_keys"] or found["bad_scores"]:
        raise ValueError(f"{path}: {found.asDict()}")
    return df


def read_layer(edges: DataFrame, label: str, features: int | None = None) -> DataFrame:
    """A layer of ring edges (feature_id, x1, y1, x2, y2), refused if it is empty or has another number of features."""
    require_columns(edges, ["feature_id", "x1", "y1", "x2", "y2"], label)
    n = edges.agg(F.count_distinct("feature_id").alias("n")).first()["n"]
    if not n or features is not None and n != features:
        raise ValueError(f"{label} has {n} features")
    return edges


def polygon_checks(edges: DataFrame, key: str = "feature_id") -> DataFrame:
    """One row over rings of edges: features, edges, null ids, rings that don't close or have under three edges, edges with a missing or non-finite end.

    A ring closes if every point that an edge ends in is one that an edge starts in, as often.
    """
    ends = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(1).alias("d")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"), F.lit(-1).alias("d")))
    coordinates = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    bad = F.lit(False)
    for c in coordinates:
        bad = bad | c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    points = edges.select(key, F.explode(ends).alias("p")).groupBy(key, "p.x", "p.y").agg(F.sum("p.d").alias("open"))
    open_rings = points.groupBy(key).agg(F.max(F.abs("open")).alias("open"))
    per = edges.groupBy(key).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"))
    joined = per.join(open_rings, per[key].eqNullSafe(open_rings[key])).drop(open_rings[key])
    return joined.agg(
        F.count("*").alias("features"), F.coalesce(F.sum("n"), F.lit(0)).alias("edges"), F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_ids"),
        F.count_if(F.col("open") != 0).alias("open_rings"), F.count_if(F.col("n") < 3).alias("short_rings"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_edges"),
    )


def normalise(features: DataFrame, source: str, id_col: str, name: Column, designation: str, status: str | None, authority: str) -> DataFrame:
    """(source, source_id, name, designation, status, authority): protected records of any register in one schema."""
    return features.select(
        F.lit(source).alias("source"), F.col(id_col).cast("string").alias("source_id"), name.alias("name"), F.col(designation).alias("designation"),
        (F.col(status) if status else F.lit(None).cast("string")).alias("status"), F.lit(authority).alias("authority"),
    )


def grid_cells(bounds: DataFrame) -> DataFrame:
    """(hex_id, grid_col, grid_row): all cells that touch the rectangle of the one row (min_x, min_y, max_x, max_y).

    Rows, then columns of a row, are sequences a little wider than needed; the exact test
    is by separating axes (those of the rectangle and the three of the hexagon), borders
    included.
    """
    side, half = hexgrid.SIDE, hexgrid.WIDTH / 2
    step = 1.5 * side
    first, last = F.floor((F.col("min_y") - side) / step) - 1, F.ceil((F.col("max_y") + side) / step) + 1
    rows = bounds.withColumn("grid_row", F.explode(F.sequence(first, last))).withColumn("grid_row", F.col("grid_row").cast("int")).repartition("grid_row")
    low, high = F.floor((F.col("min_x") - half) / hexgrid.WIDTH - F.col("grid_row") / 2.0) - 1, F.ceil((F.col("max_x") + half) / hexgrid.WIDTH - F.col("grid_row") / 2.0) + 1
    every = rows.withColumn("grid_col", F.explode(F.sequence(low, high))).withColumn("grid_col", F.col("grid_col").cast("int"))
    x, y = hexgrid.centre(F.col("grid_col"), F.col("grid_row"))
    dx, dy = x - (F.col("min_x") + F.col("max_x")) / 2, y - (F.col("min_y") + F.col("max_y")) / 2
    wide, tall = (F.col("max_x") - F.col("min_x")) / 2, (F.col("max_y") - F.col("min_y")) / 2
    touches = (F.abs(dx) <= wide + half) & (F.abs(dy) <= tall + side)
    for sign in (1.0, -1.0):
        touches = touches & (F.abs(dx * (0.5 * sign) + dy * F.lit(3**0.5 / 2)) <= wide * 0.5 + tall * F.lit(3**0.5 / 2) + half)
    return every.where(touches).select(hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")).alias("hex_id"), "grid_col", "grid_row")


def grid_check(units: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """One row: cells, repeated ids, repeated places (which would overlap), ids that don't name their place, areas that aren't a cell's."""
    corners = hexgrid.polygon(F.col("grid_col"), F.col("grid_row"))
    after = F.concat(F.slice("c", 2, 5), F.slice("c", 1, 1))
    # the corner 0 is the origin, so that the products stay small
    cross = F.aggregate(F.zip_with("c", after, lambda a, b: (a["x"] - F.col("c")[0]["x"]) * (b["y"] - F.col("c")[0]["y"]) - (b["x"] - F.col("c")[0]["x"]) * (a["y"] - F.col("c")[0]["y"])), F.lit(0.0), lambda s, v: s + v)
    rows = units.select("hex_id", "grid_col", "grid_row", corners.alias("c")).select("hex_id", "grid_col", "grid_row", (F.abs(cross) / 2).alias("area"))
    named = hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")) != F.col("hex_id")
    per = rows.groupBy("hex_id", "grid_col", "grid_row").agg(F.count("*").alias("n"), F.max(F.abs(F.col("area") - F.lit(cells.CELL_M2))).alias("gap"), F.max(named).alias("named"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("cells"), F.count_if(F.col("n") > 1).alias("repeated"), F.count_if("named").alias("misnamed"), F.count_if(F.col("gap") > tolerance).alias("other_area"))


def context_extent(study_hits: DataFrame) -> DataFrame:
    """(kind, features, inside, belt_only) from (feature_id, kind, distance to the study area)."""
    return study_hits.groupBy("kind").agg(F.count("*").alias("features"), F.count_if(F.col("distance") == 0).alias("inside"), F.count_if(F.col("distance") > 0).alias("belt_only"))


def overlaps(candidates: DataFrame, footprint: DataFrame, steps: DataFrame) -> DataFrame:
    """(hex_id, overlap_m2, overlap_fraction, steps, agrees): footprint pixels (whole runs) in every candidate cell, against its steps to protected cells.

    agrees: land that overlaps the footprint is at step 0; water in the footprint makes no step 0, so only the other way is a contradiction.
    """
    inside = runs.cell_counts(footprint).withColumnRenamed("pixels", "_n")
    rows = candidates.select("hex_id", "grid_col", "grid_row").join(inside, ["grid_col", "grid_row"], "left").join(steps.select("hex_id", "steps"), "hex_id", "left")
    area = F.coalesce("_n", F.lit(0)) * F.lit(cells.PIXEL_M2)
    return rows.select("hex_id", area.alias("overlap_m2"), (area / F.lit(cells.CELL_M2)).alias("overlap_fraction"), "steps", (~((F.col("steps") == 0) & (area == 0))).alias("agrees"))


def total_reconciliation(observed: DataFrame, expected: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, observed, expected, delta, exact): sums of columns of one table against (metric, expected) of another."""
    wide = observed.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in metrics])
    rows = wide.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("observed")) for m in metrics])).alias("r")).select("r.*")
    out = rows.join(expected, "metric", "full_outer").withColumn("delta", F.col("observed") - F.col("expected"))
    return out.select("metric", "observed", "expected", "delta", F.coalesce(F.col("delta") == 0, F.lit(False)).alias("exact"))


def area_reconciliation(units: DataFrame, indicators: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """One row: largest gap between hectares and m2 / 10000, and between both candidate fractions; ids on one side only."""
    joined = units.select("hex_id", "candidate_area_m2", F.col("candidate_fraction_of_terrestrial").alias("_f")).join(indicators.select("hex_id", "candidate_land_area_ha", "candidate_fraction_of_terrestrial"), "hex_id", "full_outer")
    area, fraction = F.abs(F.col("candidate_land_area_ha") - F.col("candidate_area_m2") / 10000.0), F.abs(F.col("candidate_fraction_of_terrestrial") - F.col("_f"))
    return joined.agg(
        F.count("*").alias("rows"), F.max(area).alias("area_gap"), F.max(fraction).alias("fraction_gap"), F.count_if(F.col("candidate_area_m2").isNull() | F.col("candidate_land_area_ha").isNull()).alias("one_sided"),
        F.count_if((area > tolerance) | (fraction > tolerance)).alias("beyond"),
    )


def input_frames(candidates: DataFrame, grid: DataFrame, hydrology: DataFrame) -> DataFrame:
    """One row of violations: ids that don't name their place, repeated places, candidates off the grid, counts that contradict each other."""
    require_columns(candidates, ["hex_id", "grid_col", "grid_row"], "candidates")
    require_columns(grid, ["grid_col", "grid_row", "terrestrial_pixels", "wetland_context_pixels"], "grid")
    require_columns(hydrology, ["wetland_pixels", "water_pixels", "hydrologic_pixels", "valid_pixels"], "hydrology")
    place = ["grid_col", "grid_row"]
    misnamed = candidates.agg(F.count_if(F.coalesce(F.col("hex_id") != hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")), F.lit(True))).alias("misnamed"))
    repeated = grid.groupBy(*place).count().agg(F.count_if(F.col("count") > 1).alias("repeated_places"))
    off = candidates.join(grid.select(*place), place, "left_anti").agg(F.count("*").alias("off_grid"))
    counts = grid.agg(F.count_if(F.col("wetland_context_pixels") > F.col("terrestrial_pixels")).alias("wetland_over_land"))
    sums = hydrology.agg(F.count_if(F.col("hydrologic_pixels") != F.col("wetland_pixels") + F.col("water_pixels")).alias("hydrologic_sums"), F.count_if(F.col("hydrologic_pixels") > F.col("valid_pixels")).alias("hydrologic_over_valid"))
    out = misnamed
    for part in (repeated, off, counts, sums):
        out = out.join(F.broadcast(part))
    return out


def geometry_audit(features: DataFrame) -> DataFrame:
    """One row over GeoJSON feature texts: features, repeated ids, types that aren't polygons, missing or non-finite coordinates, ring sizes."""
    text = F.col("feature")
    ring = F.from_json(F.get_json_object(text, "$.geometry.coordinates[0]"), "array<array<double>>")
    rows = features.select("hex_id", F.get_json_object(text, "$.geometry.type").alias("type"), ring.alias("ring")).withColumn("points", F.size("ring").cast("long"))
    bad = ~F.coalesce(F.forall("ring", lambda c: (F.size(c) == 2) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))), F.lit(False))
    open_ring = ~F.col("ring")[0].eqNullSafe(F.element_at("ring", -1))
    repeated = rows.groupBy("hex_id").count().agg(F.count_if(F.col("count") > 1).alias("repeated_ids"))
    out = rows.agg(F.count("*").alias("features"), F.sum("points").alias("coordinates"), F.count_if(F.col("type") != "Polygon").alias("other_types"), F.count_if(bad).alias("bad_rings"), F.count_if(open_ring).alias("open_rings"), F.max("points").alias("largest_ring"))
    middle = stats.percentiles(rows, [], "points", {"median_ring": 0.5})
    return out.join(F.broadcast(repeated)).join(F.broadcast(middle))
