"""Relations of hexagon cells to a footprint of rings: distances, contact, pixel overlap, and where they disagree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import cells, geometry, runs
from terraweave.sources.storage import materialise

TOUCH = 1e-9  # metres that count as contact


def centres(units: DataFrame) -> DataFrame:
    x, y = hexgrid.centre(F.col("grid_col"), F.col("grid_row"))
    return units.select("hex_id", x.alias("x"), y.alias("y"))


def cell_edges(units: DataFrame) -> DataFrame:
    """(hex_id, x1, y1, x2, y2): six sides a cell."""
    corners = units.select("hex_id", hexgrid.polygon(F.col("grid_col"), F.col("grid_row")).alias("c"))
    sides = F.transform("c", lambda a, i: F.struct(a.alias("a"), F.col("c")[(i + 1) % 6].alias("b")))
    return corners.select("hex_id", F.explode(sides).alias("s")).select("hex_id", F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))


def _meets_cell(x: Column, y: Column) -> Column:
    """Whether the side (x1, y1, x2, y2) meets the closed cell around (x, y): no axis separates them.

    The axes of two convex shapes that can separate them are the normals of their sides:
    three of the cell and one of the side itself.
    """
    ax, ay, bx, by = F.col("x1") - x, F.col("y1") - y, F.col("x2") - x, F.col("y2") - y
    half, meets = hexgrid.WIDTH / 2, F.lit(True)
    for degrees in (0, 60, 120):
        c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
        a, b = ax * F.lit(c) + ay * F.lit(s), bx * F.lit(c) + by * F.lit(s)
        meets = meets & (F.least(a, b) <= half) & (F.greatest(a, b) >= -half)
    nx, ny = ay - by, bx - ax
    corners = [(hexgrid.SIDE * math.cos(math.radians(30 + 60 * k)), hexgrid.SIDE * math.sin(math.radians(30 + 60 * k))) for k in range(3)]  # the other three are opposite
    support = F.greatest(*[F.abs(nx * F.lit(cx) + ny * F.lit(cy)) for cx, cy in corners])
    return meets & (F.abs(ax * nx + ay * ny) <= support)


def touched_cells(units: DataFrame, edges: DataFrame, key: str = "feature_id", tile: float = 2000.0) -> DataFrame:
    """(hex_id), distinct: cells that a ring meets, holds or lies in.

    A side is dealt to the tiles that come within a cell's radius of it, a cell to the tile
    of its centre, so each pair is tested once, by axes. Cells without a side in them lie in a ring if
    their centre does. Null coordinates are dropped; an empty side gives no rows.
    """
    placed = centres(units).withColumns({"tx": F.floor(F.col("x") / F.lit(tile)), "ty": F.floor(F.col("y") / F.lit(tile))})
    sides = geometry._tiled(edges.select(*geometry.ENDS), tile, hexgrid.SIDE)
    met = placed.join(sides, ["tx", "ty"]).where(_meets_cell(F.col("x"), F.col("y"))).select("hex_id")
    held = geometry.contains(placed, edges, "hex_id", key, tile).select("hex_id")
    return met.unionByName(held).distinct()


def relations(candidates: DataFrame, edges: DataFrame, footprint: DataFrame, land: DataFrame, steps: DataFrame) -> DataFrame:
    """One row a candidate: what the rings, the pixels and the grid say of it and the footprint.

    candidates: (hex_id, grid_col, grid_row); edges: rings (feature_id, x1, y1, x2, y2);
    footprint: whole runs of pixels; land: (grid_col, grid_row, protected_fraction) of
    terrestrial pixels; steps: (hex_id, steps). distance_m, centre_distance_m: to the rings,
    0 inside, null without any; intersects by axes; overlap by pixel centres; land_support:
    whether land of the cell is protected. outline_only: the rings meet the cell, but none of its land pixels.
    """
    units = materialise(candidates.select("hex_id", "grid_col", "grid_row"), "relation-cells")
    rings = materialise(edges, "relation-rings")
    point = centres(units).select("hex_id", F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    gap = geometry.nearest(cell_edges(units), rings).withColumnRenamed("distance", "distance_m")
    centre_gap = geometry.nearest(materialise(point, "relation-centres"), rings).withColumnRenamed("distance", "centre_distance_m")
    hit = touched_cells(units, rings).withColumn("_hit", F.lit(True))
    inside = runs.cell_counts(footprint).withColumnRenamed("pixels", "_n")
    rows = units.join(gap, "hex_id", "left").join(centre_gap, "hex_id", "left").join(hit, "hex_id", "left").join(inside, ["grid_col", "grid_row"], "left")
    rows = rows.join(land.select("grid_col", "grid_row", "protected_fraction"), ["grid_col", "grid_row"], "left").join(steps.select("hex_id", "steps"), "hex_id", "left")
    intersects, area = F.coalesce("_hit", F.lit(False)), F.coalesce("_n", F.lit(0)) * F.lit(cells.PIXEL_M2)
    support = F.coalesce(F.col("protected_fraction") > 0, F.lit(False))
    return rows.select(
        "hex_id", "distance_m", "centre_distance_m", intersects.alias("intersects"), F.coalesce(F.col("centre_distance_m") <= TOUCH, F.lit(False)).alias("centre_within"),
        area.alias("overlap_m2"), (area / F.lit(cells.CELL_M2)).alias("overlap_fraction"), F.coalesce("protected_fraction", F.lit(0.0)).alias("protected_fraction"), support.alias("land_support"), "steps",
        (intersects & ~support).alias("outline_only"),
    )


def relation_audit(related: DataFrame, candidates: DataFrame, near: float = 500.0) -> DataFrame:
    """One row of counts over ``relations``: contact against land support, and distances against grid steps.

    candidates: (hex_id, sea_pixels, inland_water_pixels, boundary_edge_flag). outline_only
    = intersecting less those with land support, since support without contact (by pixels
    whose centre lies in a ring) can't be; such rows are counted as support_only.
    """
    rows = related.join(candidates.select("hex_id", "sea_pixels", "inland_water_pixels", "boundary_edge_flag"), "hex_id", "left")
    only, close = F.col("outline_only"), F.col("distance_m") <= near
    middle = lambda c, p: F.percentile(c, p)
    return rows.agg(
        F.count("*").alias("candidates"), F.count_if("intersects").alias("intersecting"), F.count_if("centre_within").alias("centres_within"), F.count_if("land_support").alias("with_land_support"), F.count_if(only).alias("outline_only"),
        F.count_if(F.col("land_support") & ~F.col("intersects")).alias("support_only"), F.count_if(only & (F.col("sea_pixels") > 0)).alias("outline_only_sea"), F.count_if(only & (F.col("inland_water_pixels") > 0)).alias("outline_only_water"),
        F.count_if(only & F.col("boundary_edge_flag")).alias("outline_only_edge"), F.count_if(close & (F.col("steps") > 1)).alias("near_but_many_steps"), F.count_if(~close & (F.col("steps") <= 1)).alias("far_but_few_steps"),
        F.count_if(F.col("intersects") != (F.col("distance_m") <= TOUCH)).alias("contact_mismatches"), F.coalesce(F.sum("overlap_m2"), F.lit(0.0)).alias("overlap_m2"), F.max("distance_m").alias("largest_distance_m"),
    )


def extent_areas(footprint: DataFrame, study: DataFrame, context: DataFrame, pixel_m2: float = 100.0) -> DataFrame:
    """One row of areas of the footprint: inside the study area, in the belt of the context around it, and beyond; all three are runs."""
    f, s, c = (F.col(f"n_{n}") > 0 for n in ("footprint", "study", "context"))
    parts = {"inside_m2": f & s, "belt_m2": f & ~s & c, "beyond_m2": f & ~s & ~c, "footprint_m2": f}
    return runs.sweep(footprint=footprint, study=study, context=context).agg(*[(runs.pixels_in(x) * F.lit(pixel_m2)).alias(n) for n, x in parts.items()])
