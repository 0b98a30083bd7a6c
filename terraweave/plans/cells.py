"""Queries from pixels to cells and indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.operators import cells, delivery, neighbours, ranks, raster, runs, semantics, stats
from terraweave.functions import hexgrid
from terraweave.sources import projection as p
from terraweave.sources.storage import materialise

UNIT_COLUMNS = ["hex_id", "grid_col", "grid_row", "valid_pixels", "terrestrial_pixels", "candidate_pixels", "habitat_context_pixels", "terrestrial_area_m2", "candidate_area_m2", "terrestrial_fraction", "candidate_fraction_of_terrestrial"]


def s1_pixel_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.pixels(spark, sf_dir).groupBy("code").agg(F.count("*").alias("pixels"), F.min("px_col").alias("min_col"), F.max("px_row").alias("max_row"))


def s1_pixel_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.pixels(spark, sf_dir).agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y"))


def s1_first_page_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that several tiles return are kept once, the first tile wins."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    first = lines.groupBy("l_suppkey").agg(F.min(F.struct("l_orderkey", "l_linenumber")).alias("at"), F.count("*").alias("members"))
    return first.select(F.col("l_suppkey").alias("feature_id"), F.col("at.l_orderkey").alias("tile"), F.col("at.l_linenumber").alias("seq"), "members")


def s2_class_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantics.class_audit(p.pixels(spark, sf_dir))


def s2_role_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantics.role_overlaps(p.pixels(spark, sf_dir))


def s2_unknown_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = p.all_pixels(spark, sf_dir).withColumn("code", F.when(F.col("px_col") % 1000 == 7, F.lit(999)).otherwise(F.col("code")))
    return semantics.unknown_codes(pixels).select("code", F.col("count").alias("pixels"))


def s2_hydrologic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.hydrology(p.counts(spark, sf_dir))


def s2_eligible_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.eligible(p.units(spark, sf_dir)).select(*UNIT_COLUMNS)


def s2_record_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = p.protected(spark, sf_dir)
    tagged = p.national(features).select(F.lit("national").alias("source"), "feature_id", "kind").unionByName(p.natura(features).select(F.lit("natura").alias("source"), "feature_id", "kind"))
    return tagged.groupBy("source", "kind").agg(F.count("*").alias("features"), F.count_distinct("feature_id").alias("ids"))


def s2_protected_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    land = p.marked_pixels(spark, sf_dir).where(cells.has_role("terrestrial_land"))
    return land.where("protected").groupBy("code").agg(F.count("*").alias("pixels"))


def s2_delivery_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    value = F.col("p_retailprice").cast("double") / 7.0
    return parts.select("p_partkey", delivery.exact_round(3)(value).alias("score"), delivery.exact_round(5)(value / 1000.0).alias("fraction"))


def s3_hex_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = hexgrid.centre(F.col("grid_col"), F.col("grid_row"))
    corners = hexgrid.polygon(F.col("grid_col"), F.col("grid_row"))
    units = p.units(spark, sf_dir)
    return units.select("hex_id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), F.size(corners).alias("corners"), *[F.round(corners[i][k], 6).alias(f"{k}{i}") for i in range(6) for k in ("x", "y")])


def s3_point_to_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.pixels(spark, sf_dir).groupBy("grid_col", "grid_row").agg(F.count("*").alias("pixels"), F.min("px_col").alias("min_col"), F.max("px_col").alias("max_col"))


def s3_rasterise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.rasterise(p.diamond_edges(p.national(p.protected(spark, sf_dir)).unionByName(p.natura(p.protected(spark, sf_dir))))).groupBy("feature_id").agg(
        F.count("*").alias("pixels"), F.min("px_col").alias("min_col"), F.max("px_col").alias("max_col"), F.min("px_row").alias("min_row"), F.max("px_row").alias("max_row")
    )


def s3_union_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = p.protected(spark, sf_dir)
    return runs.union_areas(raster.spans(p.diamond_edges(p.national(features))), raster.spans(p.diamond_edges(p.natura(features))))


def s3_water_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = runs.code_counts(runs.overlaid(p.coded_runs(spark, sf_dir), p.footprint_runs(spark, sf_dir)))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return counts.agg(total(F.col("pixels")).alias("pixels"), total(F.when(F.col("code") == 62, F.col("pixels"))).alias("sea"), total(F.when(F.col("code") == 61, F.col("pixels"))).alias("inland"))


def s3_nearest_protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = p.full_counts(spark, sf_dir)
    return neighbours.nearest_steps(cells.eligible(cells.analysis_units(counts)), counts.where("protected_pixels > 0"))


def s3_neighbour_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = p.units(spark, sf_dir).select("hex_id", "grid_col", "grid_row")
    near = neighbours.neighbours(units, units)
    (xa, ya), (xb, yb) = hexgrid.centre(F.col("n_grid_col") - F.col("dc"), F.col("n_grid_row") - F.col("dr")), hexgrid.centre(F.col("n_grid_col"), F.col("n_grid_row"))
    gap = F.round(F.sqrt((xa - xb) * (xa - xb) + (ya - yb) * (ya - yb)), 6)
    return near.groupBy("ring").agg(F.count("*").alias("pairs"), F.min(gap).alias("min_gap"), F.max(gap).alias("max_gap"))


def s5_pixel_to_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.counts(spark, sf_dir)


def s5_pixel_to_protection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.protection(p.marked_pixels(spark, sf_dir))


def s5_habitat_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.packed_shares(p.units(spark, sf_dir), cells.is_eligible(), {"habitat": ("habitat_context_pixels", "terrestrial_pixels")})


def s5_land_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair, carry = ("artificial_pixels", "terrestrial_pixels"), ["candidate_area_m2", "artificial_pixels", "terrestrial_pixels"]
    near = neighbours.packed_shares(p.units(spark, sf_dir), cells.is_eligible(), {"artificial": pair}, carry)
    own = {"candidate_land_area_ha": F.col("candidate_area_m2") / 10000.0, "artificial_focal_fraction": F.try_divide(F.col("artificial_pixels") * F.lit(1.0), F.col("terrestrial_pixels"))}
    return near.withColumns(own).select("hex_id", *own, *[x for x in near.columns if x not in ("hex_id", *carry)])


def _hydrology(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Hydrology of all cells, and the condition for candidates."""
    return cells.hydrology(p.counts(spark, sf_dir), cells.is_eligible().alias("eligible")), F.col("eligible")


def s5_riparian_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.packed_riparian(*_hydrology(spark, sf_dir))


def s5_protected_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = ("protected_pixels", "terrestrial_pixels")
    near = neighbours.packed_shares(p.full_counts(spark, sf_dir).where("terrestrial_pixels > 0"), cells.is_eligible(), {"protected": pair}, list(pair))
    return near.withColumn("protected_focal_fraction", F.try_divide(F.col(pair[0]) * F.lit(1.0), F.col(pair[1]))).drop(*pair)


def s5_network_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = neighbours.packed_network(p.counts(spark, sf_dir), cells.is_eligible()).drop("habitat_adjacent_fraction", "habitat_local_fraction")
    out = near.select(hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")).alias("hex_id"), *near.columns[2:])
    rounded = ["bridge_strength_mean", "neighbor_habitat_mean", "opposing_balance_ratio", "dominant_opposing_pair_share"]
    return out.withColumns({c: F.round(c, 9) for c in rounded})


def s5_candidate_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.eligibility_diagnostics(p.units(spark, sf_dir))


def s5_cell_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.distribution(p.units(spark, sf_dir), ["terrestrial_fraction", "candidate_fraction_of_terrestrial", "habitat_fraction_of_terrestrial"])


def s5_coordinate_thirds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.coordinate_thirds(p.units(spark, sf_dir))


def s6_habitat_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = materialise(s5_habitat_indicators(spark, sf_dir).select("hex_id", "habitat_local_fraction"), "indicators")
    return ranks.percentile_score(near, "habitat_local_fraction", "habitat_context_score")


def s6_riparian_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = materialise(s5_riparian_indicators(spark, sf_dir).select("hex_id", "riparian_focal_fraction"), "indicators")
    return ranks.positive_percentile_score(near, "riparian_focal_fraction", "riparian_opportunity_score")


def s8_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    cand = cells.eligible(p.units(spark, sf_dir))
    feature = delivery.features(cand, ["hex_id", "candidate_pixels"])
    x, y = hexgrid.centre(F.col("grid_col"), F.col("grid_row"))
    lon, lat = delivery.lon_lat(x, y, 4)
    return cand.select("hex_id", lon.alias("lon"), lat.alias("lat")).join(feature.select("hex_id", F.get_json_object("feature", "$.id").alias("feature_id"), F.size(F.from_json(F.get_json_object("feature", "$.geometry.coordinates[0]"), "array<array<double>>")).alias("ring_points")), "hex_id")


CELLS = "WITH " + p.CELL_SQL
PIX = "WITH " + p.PIXEL_SQL
PROT = p.PROTECTED_SQL
_NEAR = """, near AS (
  SELECT c.hex_id, count(*) FILTER (WHERE o.ring = 1 AND g.grid_col IS NOT NULL) AS ac, count(g.grid_col) AS lc,
    sum(CASE WHEN o.ring = 1 THEN g.{part} ELSE 0 END) AS ap, sum(CASE WHEN o.ring = 1 THEN g.{whole} ELSE 0 END) AS aw, sum(g.{part}) AS lp, sum(g.{whole}) AS lw
  FROM cand c CROSS JOIN off o LEFT JOIN {grid} g ON g.grid_col = c.grid_col + o.dc AND g.grid_row = c.grid_row + o.dr GROUP BY 1
), sh AS (
  SELECT hex_id, ac AS {prefix}_adjacent_cells, lc AS {prefix}_local_cells, CAST(ap AS DOUBLE) / nullif(aw, 0) AS {prefix}_adjacent_fraction, CAST(lp AS DOUBLE) / nullif(lw, 0) AS {prefix}_local_fraction FROM near
)"""


def _near(part: str, whole: str, grid: str, prefix: str) -> str:
    return _NEAR.format(part=part, whole=whole, grid=grid, prefix=prefix)


_PGRID = """, pg AS (
  SELECT grid_col, grid_row, count(*) AS terrestrial_pixels, count(f.px_col) AS protected_pixels, count(f.px_col) * 1.0::DOUBLE / count(*) AS protected_fraction
  FROM px LEFT JOIN foot f USING (px_col, px_row) WHERE code NOT IN (61, 62) GROUP BY 1, 2
)"""
_HABITAT = CELLS + _near("habitat_context_pixels", "terrestrial_pixels", "units", "habitat")
_RIPARIAN = CELLS + _near("hydrologic_pixels", "nonmarine_pixels", "hyd", "riparian") + """, rip AS (
  SELECT sh.*, h.hydrologic_pixels * 1.0::DOUBLE / nullif(h.nonmarine_pixels, 0) AS riparian_focal_fraction,
    greatest(h.hydrologic_pixels * 1.0::DOUBLE / nullif(h.nonmarine_pixels, 0), riparian_adjacent_fraction) AS riparian_near_fraction
  FROM sh JOIN cand USING (hex_id) LEFT JOIN hyd h USING (grid_col, grid_row)
)"""
_DIST = """SELECT metric, count(v) AS n, count(*) FILTER (WHERE v IS NULL) AS missing, round(min(v), 6) AS min, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(max(v), 6) AS max,
  round(quantile_cont(v, 0.10), 6) AS p10, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.75), 6) AS p75,
  round(quantile_cont(v, 0.9), 6) AS p90, round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99 FROM ({src}) GROUP BY metric"""
_GROUPS = "(VALUES " + ", ".join(f"({code}, '{g}')" for g, codes in semantics.GROUP_CODES.items() for code in codes) + ") g(code, grp)"
_ROLES = "(VALUES " + ", ".join(f"({code}, '{r}')" for r in semantics.ROLE_GROUPS for code in cells.codes_of(r)) + ") r(code, role)"

#: Corners of a cell from its centre, from 30 degrees on.
_CORNERS = [(250.0, hexgrid.SIDE / 2), (0.0, hexgrid.SIDE), (-250.0, hexgrid.SIDE / 2), (-250.0, -hexgrid.SIDE / 2), (0.0, -hexgrid.SIDE), (250.0, -hexgrid.SIDE / 2)]

ORACLES = {
    "s1_pixel_scan": PIX + " SELECT CAST(code AS INTEGER) AS code, count(*) AS pixels, CAST(min(px_col) AS INTEGER) AS min_col, CAST(max(px_row) AS INTEGER) AS max_row FROM px GROUP BY 1",
    "s1_pixel_centres": PIX + " SELECT min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM px",
    "s1_first_page_wins": "SELECT l_suppkey AS feature_id, l_orderkey AS tile, l_linenumber AS seq, members FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS k, count(*) OVER (PARTITION BY l_suppkey) AS members FROM lineitem) WHERE k = 1",
    "s2_class_audit": PIX + f""", c AS (SELECT code, count(*) AS n FROM px GROUP BY 1), t AS (SELECT sum(n) AS v FROM c), u AS (
      SELECT 'code' AS level, CAST(code AS VARCHAR) AS name, n FROM c UNION ALL SELECT 'group', grp, n FROM c JOIN {_GROUPS} USING (code) UNION ALL SELECT 'role', role, n FROM c JOIN {_ROLES} USING (code))
      SELECT level, name, CAST(sum(n) AS BIGINT) AS pixels, CAST(sum(n) AS BIGINT) * 0.0001::DOUBLE AS area_km2, 100.0::DOUBLE * CAST(sum(n) AS BIGINT) / max(v) AS percent_of_valid FROM u, t GROUP BY 1, 2""",
    "s2_role_overlaps": PIX + f" SELECT a.role AS role_a, b.role AS role_b, count(*) AS pixels FROM px JOIN {_ROLES.replace(' r(', ' a(')} USING (code) JOIN {_ROLES.replace(' r(', ' b(')} USING (code) WHERE a.role < b.role GROUP BY 1, 2",
    "s2_unknown_codes": PIX + " SELECT CAST(999 AS INTEGER) AS code, count(*) AS pixels FROM allpx WHERE px_col % 1000 = 7 HAVING count(*) > 0",
    "s2_hydrologic_counts": CELLS + " SELECT * FROM hyd",
    "s2_eligible_cells": CELLS + f" SELECT {', '.join(UNIT_COLUMNS)} FROM cand",
    "s2_record_filters": "WITH " + PROT + " SELECT CASE WHEN kind = 'SCI' THEN 'natura' ELSE 'national' END AS source, kind, count(*) AS features, count(DISTINCT feature_id) AS ids FROM prot WHERE kind = 'SCI' OR (kind IN ('Nationalpark', 'Naturreservat') AND status = 'Gällande') GROUP BY 1, 2",
    "s2_protected_predicate": PIX + "," + PROT + " SELECT CAST(code AS INTEGER) AS code, count(*) AS pixels FROM px JOIN foot USING (px_col, px_row) WHERE code NOT IN (61, 62) GROUP BY 1",
    "s2_delivery_rounding": "SELECT p_partkey, CAST(format('{:.3f}', CAST(p_retailprice AS DOUBLE) / 7.0::DOUBLE) AS DOUBLE) AS score, CAST(format('{:.5f}', CAST(p_retailprice AS DOUBLE) / 7.0::DOUBLE / 1000.0::DOUBLE) AS DOUBLE) AS fraction FROM part",
    "s3_hex_geometry": CELLS + f" SELECT hex_id, round((grid_col + grid_row / 2.0::DOUBLE) * 500.0::DOUBLE, 6) AS x, round(grid_row * {1.5 * hexgrid.SIDE!r}::DOUBLE, 6) AS y, CAST(6 AS INTEGER) AS corners, " + ", ".join(f"round(round((grid_col + grid_row / 2.0::DOUBLE) * 500.0::DOUBLE + {dx!r}::DOUBLE, 9), 6) AS x{i}, round(round(grid_row * {1.5 * hexgrid.SIDE!r}::DOUBLE + {dy!r}::DOUBLE, 9), 6) AS y{i}" for i, (dx, dy) in enumerate(_CORNERS)) + " FROM units",
    "s3_point_to_hex": PIX + " SELECT grid_col, grid_row, count(*) AS pixels, CAST(min(px_col) AS INTEGER) AS min_col, CAST(max(px_col) AS INTEGER) AS max_col FROM px GROUP BY 1, 2",
    "s3_rasterise": "WITH " + PROT + " SELECT feature_id, count(*) AS pixels, CAST(min(px_col) AS INTEGER) AS min_col, CAST(max(px_col) AS INTEGER) AS max_col, CAST(min(px_row) AS INTEGER) AS min_row, CAST(max(px_row) AS INTEGER) AS max_row FROM cover GROUP BY 1",
    "s3_union_areas": "WITH " + PROT + ", b AS (SELECT px_col, px_row, max(CASE WHEN kind <> 'SCI' THEN 1 ELSE 0 END) AS f, max(CASE WHEN kind = 'SCI' THEN 1 ELSE 0 END) AS s FROM cover GROUP BY 1, 2) SELECT count(*) FILTER (WHERE f = 1) * 100.0::DOUBLE AS first_m2, count(*) FILTER (WHERE s = 1) * 100.0::DOUBLE AS second_m2, count(*) FILTER (WHERE f = 1 AND s = 1) * 100.0::DOUBLE AS intersection_m2, count(*) * 100.0::DOUBLE AS union_m2, (count(*) FILTER (WHERE f = 1) + count(*) FILTER (WHERE s = 1)) * 100.0::DOUBLE AS summed_m2 FROM b",
    "s3_water_share": PIX + "," + PROT + " SELECT count(*) AS pixels, count(*) FILTER (WHERE code = 62) AS sea, count(*) FILTER (WHERE code = 61) AS inland FROM px JOIN foot USING (px_col, px_row)",
    "s3_nearest_protected": CELLS + "," + PROT + _PGRID + " SELECT c.hex_id, CAST(min(greatest(abs(c.grid_col - s.grid_col), abs(c.grid_row - s.grid_row), abs(c.grid_col - s.grid_col + c.grid_row - s.grid_row))) AS INTEGER) AS steps FROM cand c, (SELECT * FROM pg WHERE protected_pixels > 0) s GROUP BY 1",
    "s3_neighbour_geometry": CELLS + f" SELECT CAST(o.ring AS INTEGER) AS ring, count(*) AS pairs, min(round(sqrt(((c.grid_col + c.grid_row / 2.0::DOUBLE) * 500 - (g.grid_col + g.grid_row / 2.0::DOUBLE) * 500) ** 2 + ((c.grid_row - g.grid_row) * {1.5 * hexgrid.SIDE!r}::DOUBLE) ** 2), 6)) AS min_gap, max(round(sqrt(((c.grid_col + c.grid_row / 2.0::DOUBLE) * 500 - (g.grid_col + g.grid_row / 2.0::DOUBLE) * 500) ** 2 + ((c.grid_row - g.grid_row) * {1.5 * hexgrid.SIDE!r}::DOUBLE) ** 2), 6)) AS max_gap FROM units c CROSS JOIN off o JOIN units g ON g.grid_col = c.grid_col + o.dc AND g.grid_row = c.grid_row + o.dr GROUP BY 1",
    "s5_pixel_to_cell": CELLS + " SELECT * FROM cnt",
    "s5_pixel_to_protection": PIX + "," + PROT + _PGRID + " SELECT * FROM pg",
    "s5_habitat_indicators": _HABITAT + " SELECT * FROM sh",
    "s5_land_indicators": CELLS + _near("artificial_pixels", "terrestrial_pixels", "units", "artificial") + " SELECT sh.*, candidate_area_m2 / 10000.0::DOUBLE AS candidate_land_area_ha, artificial_pixels * 1.0::DOUBLE / terrestrial_pixels AS artificial_focal_fraction FROM sh JOIN cand USING (hex_id)",
    "s5_riparian_indicators": _RIPARIAN + " SELECT * FROM rip",
    "s5_protected_indicators": CELLS + "," + PROT + _PGRID + _near("protected_pixels", "terrestrial_pixels", "pg", "protected") + " SELECT sh.*, protected_fraction AS protected_focal_fraction FROM sh JOIN cand USING (hex_id) LEFT JOIN pg USING (grid_col, grid_row)",
    "s5_network_indicators": CELLS + """, w AS (SELECT c.hex_id, o.dc, o.dr, coalesce(g.habitat_fraction_of_terrestrial, 0) AS v, g.grid_col IS NULL AS gone FROM cand c JOIN off o ON o.ring = 1 LEFT JOIN units g ON g.grid_col = c.grid_col + o.dc AND g.grid_row = c.grid_row + o.dr),
      a AS (SELECT hex_id, least(max(v) FILTER (WHERE dc = 1 AND dr = 0), max(v) FILTER (WHERE dc = -1 AND dr = 0)) AS a, least(max(v) FILTER (WHERE dc = 0 AND dr = 1), max(v) FILTER (WHERE dc = 0 AND dr = -1)) AS b,
        least(max(v) FILTER (WHERE dc = 1 AND dr = -1), max(v) FILTER (WHERE dc = -1 AND dr = 1)) AS c, sum(v) AS t, count(*) FILTER (WHERE gone) AS gone FROM w GROUP BY 1), m AS (SELECT *, greatest(a, b, c) AS g FROM a)
      SELECT hex_id, a AS bridge_axis_a_strength, b AS bridge_axis_b_strength, c AS bridge_axis_c_strength, g AS bridge_strength_max, round((a + b + c) / 3, 9) AS bridge_strength_mean, round(t / 6, 9) AS neighbor_habitat_mean,
        round(coalesce(2 * (a + b + c) / nullif(t, 0), 0), 9) AS opposing_balance_ratio, round(coalesce(2 * g / nullif(t, 0), 0), 9) AS dominant_opposing_pair_share, CASE WHEN g - a <= 1e-12 THEN 'axis_a' WHEN g - b <= 1e-12 THEN 'axis_b' ELSE 'axis_c' END AS strongest_axis,
        CAST(g - a <= 1e-12 AS INTEGER) + CAST(g - b <= 1e-12 AS INTEGER) + CAST(g - c <= 1e-12 AS INTEGER) AS strongest_axis_tie_count, gone AS adjacent_cells_missing FROM m""",
    "s5_candidate_diagnostics": CELLS + " SELECT CASE WHEN candidate_area_m2 >= 50000 AND candidate_fraction_of_terrestrial >= 0.25 THEN 'pass' WHEN candidate_fraction_of_terrestrial >= 0.25 THEN 'area_only' WHEN candidate_area_m2 >= 50000 THEN 'fraction_only' ELSE 'both' END AS outcome, count(*) AS cells, sum(candidate_area_m2) AS candidate_area_m2 FROM units GROUP BY 1",
    "s5_cell_distribution": CELLS + " " + _DIST.replace("{src}", " UNION ALL ".join(f"SELECT '{c}' AS metric, {c} AS v FROM units" for c in ("terrestrial_fraction", "candidate_fraction_of_terrestrial", "habitat_fraction_of_terrestrial"))),
    "s5_coordinate_thirds": CELLS + ", e AS (SELECT min(grid_col) AS x0, (max(grid_col) - min(grid_col)) / 3.0::DOUBLE AS dx, min(grid_row) AS y0, (max(grid_row) - min(grid_row)) / 3.0::DOUBLE AS dy FROM units) SELECT CASE WHEN grid_col < x0 + dx THEN 'low' WHEN grid_col < x0 + 2 * dx THEN 'middle' ELSE 'high' END AS third_x, CASE WHEN grid_row < y0 + dy THEN 'low' WHEN grid_row < y0 + 2 * dy THEN 'middle' ELSE 'high' END AS third_y, count(*) AS rows FROM units, e GROUP BY 1, 2",
    "s6_habitat_score": _HABITAT + ", k AS (SELECT hex_id, habitat_local_fraction, rank() OVER (ORDER BY habitat_local_fraction) + (count(*) OVER (PARTITION BY habitat_local_fraction) - 1) / 2.0::DOUBLE AS r, count(*) OVER () AS n FROM sh WHERE habitat_local_fraction IS NOT NULL) SELECT sh.hex_id, sh.habitat_local_fraction, 100.0::DOUBLE * (r - 1) / (n - 1) AS habitat_context_score FROM sh LEFT JOIN k USING (hex_id)",
    "s6_riparian_score": _RIPARIAN + ", k AS (SELECT hex_id, rank() OVER (ORDER BY riparian_focal_fraction) + (count(*) OVER (PARTITION BY riparian_focal_fraction) - 1) / 2.0::DOUBLE AS r, count(*) OVER () AS n FROM rip WHERE riparian_focal_fraction > 0) SELECT rip.hex_id, riparian_focal_fraction, CASE WHEN riparian_focal_fraction = 0 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE * r / n END AS riparian_opportunity_score FROM rip LEFT JOIN k USING (hex_id)",
}
QUERIES = {name: f for name, f in globals().items() if name[:1] == "s" and name[1:2].isdigit() and callable(f)}
