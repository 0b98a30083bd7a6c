"""Neighbours looked up in packed tiles against joins on coordinates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import cells, neighbours, raster, runs

SCHEMA = "grid_col int, grid_row int, n long, m int, v double, keep boolean, tc string"


def grid(seed, side=14, share=0.7):
    rng = np.random.default_rng(seed)
    places = [(c, r) for c in range(-side, side) for r in range(-side, side) if rng.random() < share]
    return [(c, r, int(rng.integers(0, 100)) if rng.random() < 0.9 else None, int(rng.integers(0, 5)), float(rng.random()) if rng.random() < 0.8 else None, bool(rng.random() < 0.5), "clash") for c, r in places]


@pytest.mark.parametrize("tile", [3, 5, 64])
def test_stencil_equals_lookup(spark, tile):
    rows = grid(tile)
    by = {(c, r): (n or 0, m, v) for c, r, n, m, v, *_ in rows}
    found = neighbours.stencil(spark.createDataFrame([*rows, (None, 1, 5, 5, 1.0, True, "x")], SCHEMA).repartition(6), F.col("keep"), ["n", "m"], ["v"], tile=tile)
    got = {(r.grid_col, r.grid_row): r for r in found.collect()}
    assert set(got) == {(c, r) for c, r, *_, keep, _ in rows if keep} and found.count() == len(got)
    for (c, r), row in got.items():
        for name, rings in (("adjacent", [1]), ("local", [1, 2])):
            near = [by[c + a, r + b] for k in rings for a, b in hexgrid.ring(k) if (c + a, r + b) in by]
            assert (row[f"{name}_cells"], row[f"{name}_n"], row[f"{name}_m"]) == (len(near), sum(x[0] for x in near), sum(x[1] for x in near))
        for a, b in hexgrid.ring(1):
            assert row[f"v_{neighbours._name((a, b))}"] == by.get((c + a, r + b), (0, 0, None))[2]


def test_packed_indicators_equal_joins(spark):
    rng = np.random.default_rng(3)
    columns = ["valid_pixels", "terrestrial_pixels", "candidate_pixels", "habitat_context_pixels", "wetland_context_pixels", "inland_water_pixels", "artificial_pixels", "protected_pixels"]
    rows = [(c, r, *map(int, rng.integers(0, 2200, len(columns)) * (rng.random() < 0.9))) for c in range(12) for r in range(-9, 3) if rng.random() < 0.8]
    counts = spark.createDataFrame(rows, "grid_col int, grid_row int, " + ", ".join(f"{c} long" for c in columns))
    units = cells.analysis_units(counts)
    cand = cells.eligible(units)
    share = neighbours.share_indicators(cand, units, "habitat_context_pixels", "terrestrial_pixels", "habitat").join(neighbours.share_indicators(cand, counts, "protected_pixels", "terrestrial_pixels", "protected"), "hex_id")
    want = share.join(neighbours.network_indicators(cand, units).select("hex_id", "bridge_strength_max", "opposing_balance_ratio"), "hex_id")
    names = ["habitat_adjacent_fraction", "habitat_local_fraction", "protected_local_fraction", "bridge_strength_max", "opposing_balance_ratio"]
    got = neighbours.packed_indicators(counts, cells.is_eligible()).withColumn("hex_id", hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")))
    assert sorted(map(tuple, got.select("hex_id", *names).collect())) == sorted(map(tuple, want.select("hex_id", *names).collect())) and want.count() > 5


def test_stencil_is_one_exchange_and_empty_grids(spark):
    found = neighbours.stencil(spark.createDataFrame(grid(1), SCHEMA), F.col("keep"), ["n"], ["v"])
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert neighbours.stencil(spark.createDataFrame([], SCHEMA), F.col("keep"), ["n"]).count() == 0


def test_counts_with_footprint_equal_protection(spark):
    rng = np.random.default_rng(7)
    pixels = spark.createDataFrame([(int(c), int(r), int(code), int(c // 20), int(r // 20)) for c, r, code in zip(rng.integers(0, 90, 900), rng.integers(0, 90, 900), rng.choice([3, 61, 111, 62], 900), strict=True)], "px_col int, px_row int, code int, grid_col int, grid_row int")
    foot = runs.joined(runs.union(spark.createDataFrame([(r, 10, 40 + r) for r in range(0, 90, 2)] + [(4, 30, 80)], "px_row int, left int, right int")))
    both = cells.composition(pixels, foot)
    want = cells.protection(pixels, foot).select("grid_col", "grid_row", "terrestrial_pixels", "protected_pixels")
    got = both.where("terrestrial_pixels > 0").select("grid_col", "grid_row", "terrestrial_pixels", "protected_pixels")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, both.drop("protected_pixels").collect())) == sorted(map(tuple, cells.composition(pixels).collect()))
    assert raster.clip_to_spans(pixels, foot).count() >= want.agg(F.sum("protected_pixels")).first()[0]


def test_filter_on_cells_does_not_reach_their_derivation(spark):
    """nearest_steps drops sources without a place behind its written table, so no filter holds the derivation of a cell."""
    points = spark.range(200).selectExpr("id * 37.0 as x", "id * 11.0 as y")
    derived = hexgrid.with_cell(points).groupBy("grid_col", "grid_row").count()
    cand = derived.select(hexgrid.hex_id(F.col("grid_col"), F.col("grid_row")).alias("hex_id"), "grid_col", "grid_row")
    plans = []
    keep = neighbours.materialise
    try:
        neighbours.materialise = lambda df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), keep(df, name))[1]
        assert neighbours.nearest_steps(cand, derived).where("steps > 0").count() == 0
    finally:
        neighbours.materialise = keep
    sources = next(plan for name, plan in plans if name == "sources")
    assert "Filter" not in sources and "Aggregate" in sources
