"""Pixels marked by masks of blocks: the same as by joins with runs, and no pixel is shuffled."""

import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import geometry, neighbours, raster, runs
from terraweave.plans import cells as c
from terraweave.sources import projection as p

DATA = "/root/testdata/sf0.001"
EDGES = "feature_id int, x1 double, y1 double, x2 double, y2 double"


def ring(key, corners):
    return [(key, *a, *b) for a, b in zip(corners, [*corners[1:], corners[0]], strict=True)]


def test_clip_to_ring_equals_spans(spark):
    corners = [(3.0, -52.0), (118.0, 5.0), (61.0, 40.0), (120.0, 95.5), (5.0, 95.5), (45.0, 20.0)]  # not convex
    grid = spark.createDataFrame([(x, y) for x in range(-12, 14) for y in range(-12, 14)], "px_col int, px_row int")
    want = raster.clip_to_spans(grid, raster.spans(spark.createDataFrame(ring(1, corners), EDGES)))
    got = raster.clip_to_ring(grid.unionByName(spark.createDataFrame([(None, 1)], "px_col int, px_row int")), corners)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 40
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_block_masks_are_the_union_of_runs(spark):
    rows = [(-3, -7, 8), (0, 0, 0), (0, 3, 11), (1, 4, 5), (4, -1, 24), (4, 20, 24), (None, 1, 2), (2, 5, 4)]
    spans = spark.createDataFrame(rows, "px_row int, left int, right int")
    bits = raster.block_masks(spans).groupBy("bx", "by").agg({"mask": "bit_or"}).collect()
    got = {(bx * 5 + i, by * 5 + j) for bx, by, m in bits for j in range(5) for i in range(5) if m >> (j * 5 + i) & 1}
    assert got == {(x, r) for r, a, b in rows if r is not None for x in range(a, b + 1)}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are missing")
def test_marked_pixels_meet_no_join(spark):
    """Before, study area and footprint were joined to the pixels, and all pixels shuffled as soon as these were no longer broadcast."""
    foot = runs.joined(runs.union(raster.spans(p.footprint_edges(spark, DATA))))
    want = raster.clip_to_spans(p.pixels(spark, DATA), foot).select("px_col", "px_row").collect()
    marked = p.marked_pixels(spark, DATA)
    assert sorted(marked.where("protected").select("px_col", "px_row").collect()) == sorted(want) and want
    for plan in (marked, c.s2_protected_predicate(spark, DATA), c.s5_pixel_to_protection(spark, DATA)):
        assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_shares_without_joins(spark):
    """Before, candidates met their neighbours in joins that Spark broadcast from the driver, 18 rows a candidate."""
    rng = np.random.default_rng(5)
    rows = [(int(x), int(y), *map(int, rng.integers(0, 9, 3))) for x, y in itertools.product(range(-70, 70, 3), range(-6, 6)) if rng.random() < 0.8]
    grid = spark.createDataFrame(rows, "grid_col int, grid_row int, part long, whole long, kept long").withColumn("hex_id", hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")))
    got = neighbours.packed_shares(grid, F.col("kept") > 4, {"x": ("part", "whole")}, ["kept"])
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    cand = grid.where("kept > 4")
    want = neighbours.share_indicators(cand, grid, "part", "whole", "x").join(cand.select("hex_id", "kept"), "hex_id")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and want.count() > 100


def test_geometry_broadcasts_nothing_that_grows(spark):
    """Before, tiles' rows that Spark took for a small table went through the driver."""
    boxes = spark.createDataFrame([r for k in range(40) for r in ring(k, [(float(k), 0.0), (k + 4.0, 0.0), (k + 4.0, 6.0), (float(k), 6.0)])], EDGES)
    found = geometry.within(boxes, spark.createDataFrame(ring(1, [(0.0, -3.0), (9.0, -3.0), (9.0, -1.0), (0.0, -1.0)]), EDGES), 2.0)
    assert sorted(r.feature_id for r in found.collect()) == list(range(11))
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
