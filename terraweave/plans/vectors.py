"""Queries of cells and footprints as rings beside pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import cells, footprints, geometry, neighbours, raster, runs
from terraweave.plans import audit
from terraweave.plans import cells as c
from terraweave.plans import relations as r
from terraweave.sources import projection as p
from terraweave.sources import tiles
from terraweave.sources.storage import materialise, new_path


def _related(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counts = p.full_counts(spark, sf_dir)
    cand = materialise(cells.eligible(cells.analysis_units(counts)), "candidates")
    land = cells.protected_of(counts)
    steps = neighbours.nearest_steps(cand, land.where("protected_pixels > 0"))
    return footprints.relations(cand, p.footprint_edges(spark, sf_dir), p.footprint_runs(spark, sf_dir), land, steps), cand


def s3_vector_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate cell against the footprint's rings, pixels and grid steps."""
    related, _ = _related(spark, sf_dir)
    return related.withColumns({x: F.round(x, 6) for x in ("distance_m", "centre_distance_m")})


def s3_vector_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where contact by rings and land support by pixels differ."""
    related, cand = _related(spark, sf_dir)
    flags = geometry.near_boundary(footprints.centres(cand), p.study_edges(spark, sf_dir), 1000.0)
    return footprints.relation_audit(related, cand.join(flags, "hex_id")).withColumn("largest_distance_m", F.round("largest_distance_m", 6))


def s3_extent_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area of all records inside the study area, in the 5 km around it, and beyond."""
    study = p.study_edges(spark, sf_dir)
    records = runs.union(raster.spans(p.diamond_edges(r._customers(spark, sf_dir))))
    return footprints.extent_areas(records, raster.spans(study), raster.buffered(study, 5000.0))


def s1_tiled_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes inside the national parks, from a table of all pixels clustered by tile of which only the tiles of the parks are read."""
    path = new_path(spark, "tiled-pixels")
    tiles.write_tiled(p.all_pixels(spark, sf_dir), path, 1024)
    parks = p.protected(spark, sf_dir).where("kind = 'Nationalpark' AND status = 'Gällande'")
    mask = runs.joined(runs.union(raster.spans(p.diamond_edges(parks))))
    inside = tiles.clip_tiled(tiles.read_tiled(spark, path, "px_col int, px_row int, code int"), mask, 1024)
    return inside.groupBy("code").agg(F.count("*").alias("pixels"), F.min("px_col").alias("min_col"), F.max("px_row").alias("max_row"))


_HALF, _ROOT = repr(hexgrid.WIDTH / 2), repr(3**0.5 / 2)
_OVER = audit.ORACLES["s3_overlaps"]
_RELATED = (
    _OVER[: _OVER.rindex("SELECT hex_id, coalesce(n, 0)")].rstrip()
    + f", {r._CENTRES}, hx AS (SELECT hex_id, c.x AS hx, c.y AS hy, "
    + ", ".join(f"round(c.x + {dx!r}::DOUBLE, 9) AS x{i}, round(c.y + {dy!r}::DOUBLE, 9) AS y{i}" for i, (dx, dy) in enumerate(c._CORNERS))
    + " FROM cen c), d AS ("
    + " UNION ALL ".join(f"SELECT hex_id, hx, hy, x{i} AS x1, y{i} AS y1, x{(i + 1) % 6} AS x2, y{(i + 1) % 6} AS y2 FROM hx" for i in range(6))
    + "), dia AS ("
    + r._DIAMOND.format(src="(SELECT DISTINCT feature_id, cx, cy, r FROM box)")
    + f"""), gap AS (
  SELECT hex_id, min(CASE WHEN abs(d.hx - t.cx) + abs(d.hy - t.cy) < t.r THEN 0
    WHEN abs(t.cx - d.hx) <= {_HALF} AND abs((t.cx - d.hx) * 0.5 + (t.cy - d.hy) * {_ROOT}::DOUBLE) <= {_HALF} AND abs((t.cx - d.hx) * 0.5 - (t.cy - d.hy) * {_ROOT}::DOUBLE) <= {_HALF} THEN 0 ELSE {r._GAP} END) AS gap
  FROM d, dia t GROUP BY 1
), cgap AS (SELECT hex_id, min(CASE WHEN abs(c.x - t.cx) + abs(c.y - t.cy) < t.r THEN 0 ELSE {r._PS("c.x", "c.y", *r._B1, *r._B2)} END) AS cgap FROM cen c, dia t GROUP BY 1),
rel AS (
  SELECT hex_id, round(gap, 6) AS distance_m, round(cgap, 6) AS centre_distance_m, coalesce(gap = 0, false) AS intersects, coalesce(cgap = 0, false) AS centre_within, coalesce(n, 0) * 100.0::DOUBLE AS overlap_m2,
    coalesce(n, 0) * 100.0::DOUBLE / {cells.CELL_M2!r}::DOUBLE AS overlap_fraction, coalesce(protected_fraction, 0.0::DOUBLE) AS protected_fraction, coalesce(protected_fraction, 0) > 0 AS land_support, steps,
    coalesce(gap = 0, false) AND NOT coalesce(protected_fraction, 0) > 0 AS outline_only
  FROM cand LEFT JOIN gap USING (hex_id) LEFT JOIN cgap USING (hex_id) LEFT JOIN fn USING (grid_col, grid_row) LEFT JOIN pg USING (grid_col, grid_row) LEFT JOIN st USING (hex_id)
)"""
)
_FLAGS = f", {r._STUDY_EDGES}, fl AS (SELECT hex_id, min({r._PS('c.x', 'c.y', *r._B1, *r._B2)}) <= 1000 AS edge FROM cen c, study t GROUP BY 1)"

ORACLES = {
    "s1_tiled_clip": "WITH " + p.PIXEL_SQL + "," + p.PROTECTED_SQL + " SELECT CAST(code AS INTEGER) AS code, count(*) AS pixels, CAST(min(px_col) AS INTEGER) AS min_col, CAST(max(px_row) AS INTEGER) AS max_row FROM allpx JOIN (SELECT DISTINCT px_col, px_row FROM cover WHERE kind = 'Nationalpark') USING (px_col, px_row) GROUP BY 1",
    "s3_vector_relations": _RELATED + " SELECT * FROM rel",
    "s3_vector_audit": _RELATED
    + _FLAGS
    + """ SELECT count(*) AS candidates, count(*) FILTER (WHERE intersects) AS intersecting, count(*) FILTER (WHERE centre_within) AS centres_within, count(*) FILTER (WHERE land_support) AS with_land_support,
      count(*) FILTER (WHERE outline_only) AS outline_only, count(*) FILTER (WHERE land_support AND NOT intersects) AS support_only, count(*) FILTER (WHERE outline_only AND sea_pixels > 0) AS outline_only_sea,
      count(*) FILTER (WHERE outline_only AND inland_water_pixels > 0) AS outline_only_water, count(*) FILTER (WHERE outline_only AND edge) AS outline_only_edge, count(*) FILTER (WHERE distance_m <= 500 AND steps > 1) AS near_but_many_steps,
      count(*) FILTER (WHERE distance_m > 500 AND steps <= 1) AS far_but_few_steps, 0::BIGINT AS contact_mismatches, coalesce(sum(overlap_m2), 0) AS overlap_m2, max(distance_m) AS largest_distance_m
      FROM rel JOIN cand USING (hex_id) JOIN fl USING (hex_id)""",
    "s3_extent_areas": "WITH " + r._NORTH + ", " + r._STUDY_EDGES + ", " + audit._CUST
    + f""", bx AS (SELECT *, unnest(range(CAST(floor((cx - r) / 10) AS BIGINT), CAST(ceil((cx + r) / 10) AS BIGINT) + 1)) AS px_col FROM cust),
      bxy AS (SELECT *, unnest(range(CAST(floor((cy - r) / 10) AS BIGINT), CAST(ceil((cy + r) / 10) AS BIGINT) + 1)) AS px_row FROM bx),
      pxs AS (SELECT DISTINCT (px_col + 0.5::DOUBLE) * 10.0::DOUBLE AS x, (px_row + 0.5::DOUBLE) * 10.0::DOUBLE AS y FROM bxy WHERE abs((px_col + 0.5) * 10 - cx) + abs((px_row + 0.5) * 10 - cy) <= r),
      s AS (SELECT ({r._INSIDE_STUDY.format(x="c.x", y="c.y")}) AS inside, (SELECT min({r._PS("c.x", "c.y", *r._B1, *r._B2)}) FROM study t) AS gap FROM pxs c)
      SELECT count(*) FILTER (WHERE inside) * 100.0::DOUBLE AS inside_m2, count(*) FILTER (WHERE NOT inside AND gap <= 5000) * 100.0::DOUBLE AS belt_m2, count(*) FILTER (WHERE NOT inside AND gap > 5000) * 100.0::DOUBLE AS beyond_m2, count(*) * 100.0::DOUBLE AS footprint_m2 FROM s""",
}
QUERIES = {name: f for name, f in globals().items() if name[:1] == "s" and name[1:2].isdigit() and callable(f)}
