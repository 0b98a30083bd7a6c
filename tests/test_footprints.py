"""Cells against rings: contact by axes against distances of sides, areas against distances of pixels."""

import math

import numpy as np
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import footprints, raster, runs

EDGES = "feature_id int, x1 double, y1 double, x2 double, y2 double"


def ring(k, points):
    return [(k, *map(float, a), *map(float, b)) for a, b in zip(points, [*points[1:], points[0]], strict=True)]


def segment_gap(p, a, b):
    (px, py), (ax, ay), (bx, by) = p, a, b
    dx, dy = bx - ax, by - ay
    t = min(1.0, max(0.0, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
    return math.hypot(px - ax - t * dx, py - ay - t * dy)


def inside(p, points):
    odd = False
    for (ax, ay), (bx, by) in zip(points, [*points[1:], points[0]], strict=True):
        if (ay > p[1]) != (by > p[1]) and p[0] < ax + (p[1] - ay) * (bx - ax) / (by - ay):
            odd = not odd
    return odd


def crosses(a, b, c, d):
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0


def shapes(seed, n=25):
    """Triangles and slivers of very different size, one that holds many cells, one inside a cell."""
    rng = np.random.default_rng(seed)
    out = [[tuple(rng.uniform(-4000, 4000, 2))] for _ in range(n)]
    rings = [[c, (c[0] + s * rng.normal(), c[1] + s * rng.normal()), (c[0] + s * rng.normal(), c[1] + s * rng.normal())] for (c,), s in zip(out, rng.choice([20, 200, 900], n), strict=True)]
    return [*rings, [(-3000.5, -3000.5), (-500.5, -3100.5), (-1200.5, -600.5)], [(3.0, 4.0), (9.0, 5.0), (4.0, 11.0)]]


def test_contact_by_axes_equals_sides(spark):
    rings = shapes(4)
    edges = spark.createDataFrame([e for k, p in enumerate(rings) for e in ring(k, p)], EDGES).repartition(4)
    cells = [(f"h_{c}_{r}", c, r) for c in range(-9, 10) for r in range(-9, 10)]
    units = spark.createDataFrame(cells, "hex_id string, grid_col int, grid_row int")
    got = {r.hex_id for r in footprints.touched_cells(units, edges).collect()}
    want = set()
    for name, c, r in cells:
        x, y = (c + r / 2) * 500.0, r * 1.5 * hexgrid.SIDE
        corners = [(x + hexgrid.SIDE * math.cos(math.radians(30 + 60 * k)), y + hexgrid.SIDE * math.sin(math.radians(30 + 60 * k))) for k in range(6)]
        sides = list(zip(corners, [*corners[1:], corners[0]], strict=True))
        for p in rings:
            if inside((x, y), p) or inside(p[0], corners) or any(crosses(a, b, q, s) for a, b in sides for q, s in zip(p, [*p[1:], p[0]], strict=True)):
                want.add(name)
    assert got == want and 20 < len(want) < len(cells)


def test_buffer_holds_the_pixels_within_the_distance(spark):
    for k, points in enumerate(shapes(9, n=3)):
        edges = spark.createDataFrame(ring(k, points), EDGES)
        got = {(r.px_row, c) for r in runs.union(raster.buffered(edges, 333.0)).collect() for c in range(r.left, r.right + 1)}
        xs, ys = zip(*points, strict=True)
        want = set()
        for row in range(int(min(ys) // 10) - 40, int(max(ys) // 10) + 41, 3):
            for col in range(int(min(xs) // 10) - 40, int(max(xs) // 10) + 41, 3):
                p = (col * 10 + 5.0, row * 10 + 5.0)
                if inside(p, points) or min(segment_gap(p, a, b) for a, b in zip(points, [*points[1:], points[0]], strict=True)) <= 333.0:
                    want.add((row, col))
        looked = {(row, col) for row in range(int(min(ys) // 10) - 40, int(max(ys) // 10) + 41, 3) for col in range(int(min(xs) // 10) - 40, int(max(xs) // 10) + 41, 3)}
        assert got & looked == want


def test_relations_and_audit(spark):
    """A ring that meets a cell, but only its water: contact without land support; no ring: null distances."""
    units = spark.createDataFrame([("h_0_0", 0, 0), ("h_1_0", 1, 0), ("h_9_0", 9, 0)], "hex_id string, grid_col int, grid_row int")
    edges = spark.createDataFrame(ring(1, [(-50.3, -50.3), (50.3, -50.3), (0.3, 60.3)]) + ring(2, [(400.3, 0.3), (460.3, 0.3), (430.3, 50.3)]), EDGES)
    land = spark.createDataFrame([(0, 0, 0.25), (1, 0, 0.0)], "grid_col int, grid_row int, protected_fraction double")
    steps = spark.createDataFrame([("h_0_0", 0), ("h_1_0", 1), ("h_9_0", 9)], "hex_id string, steps int")
    found = footprints.relations(units, edges, runs.joined(runs.union(raster.spans(edges))), land, steps)
    got = {r.hex_id: r for r in found.collect()}
    assert (got["h_0_0"].intersects, got["h_0_0"].centre_within, got["h_0_0"].land_support, got["h_0_0"].outline_only) == (True, True, True, False)
    assert (got["h_1_0"].intersects, got["h_1_0"].land_support, got["h_1_0"].outline_only, got["h_1_0"].centre_within) == (True, False, True, False)
    assert not got["h_9_0"].intersects and got["h_9_0"].distance_m > 3000 and got["h_9_0"].overlap_m2 == 0
    pixels = raster.rasterise(edges).groupBy("feature_id").count()
    assert sum(r.overlap_m2 for r in got.values()) == 100.0 * pixels.agg(F.sum("count")).first()[0]
    flags = spark.createDataFrame([("h_0_0", 0, 1, True), ("h_1_0", 4, 0, True), ("h_9_0", 0, 0, False)], "hex_id string, sea_pixels int, inland_water_pixels int, boundary_edge_flag boolean")
    row = footprints.relation_audit(found, flags).first()
    assert (row.candidates, row.intersecting, row.with_land_support, row.outline_only, row.outline_only_sea, row.outline_only_water, row.outline_only_edge) == (3, 2, 1, 1, 1, 0, 1)
    assert (row.contact_mismatches, row.far_but_few_steps, row.support_only) == (0, 0, 0)
    none = footprints.relations(units, edges.limit(0), runs.union(raster.spans(edges.limit(0))), land.limit(0), steps)
    assert all(r.distance_m is None and not r.intersects and not r.land_support for r in none.collect())
    assert footprints.relation_audit(footprints.relations(units.limit(0), edges, runs.union(raster.spans(edges)), land, steps), flags).first().candidates == 0
