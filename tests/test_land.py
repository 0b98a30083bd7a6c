"""Exact values on small frames, and every query against its SQL at the smallest scale."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from terraweave.functions import hexgrid
from terraweave.operators import cells, checks, components, delivery, layers, neighbours, ranks, raster, scoring, semantics, stats

DATA = "/root/testdata/sf0.001"


def test_classes_are_disjoint_and_complete():
    codes = [c for group in semantics.GROUP_CODES.values() for c in group]
    assert len(codes) == len(set(codes)) == 51


def test_rings():
    assert len(hexgrid.ring(1)) == 6 and len(hexgrid.ring(2)) == 12


def test_eligibility_is_inclusive(spark):
    rows = [("pass", 50_000.0, 0.25), ("area", 49_900.0, 0.5), ("fraction", 50_000.0, 0.2499), ("none", 0.0, None)]
    units = spark.createDataFrame(rows, "hex_id string, candidate_area_m2 double, candidate_fraction_of_terrestrial double")
    assert [r.hex_id for r in cells.eligible(units).collect()] == ["pass"]


def test_pixel_centres_decide(spark):
    edges = [(1, 2.1, 0.0, 3.0, 0.0), (1, 3.0, 0.0, 3.0, 1.0), (1, 3.0, 1.0, 2.1, 1.0), (1, 2.1, 1.0, 2.1, 0.0)]
    found = raster.rasterise(spark.createDataFrame(edges, "feature_id int, x1 double, y1 double, x2 double, y2 double"), step=1.0)
    assert [(r.px_col, r.px_row) for r in found.collect()] == [(2, 0)]


def test_average_ranks_share_ties(spark):
    values = [1.0, 2.0, 2.0, 4.0, 5.0, 5.0, 5.0, None]
    df = spark.createDataFrame([(f"h{i}", v) for i, v in enumerate(values)], "hex_id string, v double")
    got = {r.hex_id: r.rank_avg for r in ranks.average_ranks(df, "v").collect()}
    assert [got[f"h{i}"] for i in range(8)] == [1, 2.5, 2.5, 4, 6, 6, 6, None]


def test_ordinal_ranks_split_a_value_that_many_rows_share(spark):
    rows = [(f"h{i:04d}", float(i * 7919 % 83) if i % 3 else 5.0, "ab"[i % 2]) for i in range(900)] + [("n", None, "a")]
    df = spark.createDataFrame(rows, "hex_id string, v double, g string").repartition(7)
    order = lambda r: (r[1] is None, -(r[1] or 0.0), r[0])
    got = {r.hex_id: r.rank for r in ranks.ordinal_ranks(df, "v").collect()}
    assert got == {r[0]: k + 1 for k, r in enumerate(sorted(rows, key=order))}
    inside = {r.hex_id: r.rank for r in ranks.ordinal_ranks(df, "v", within=["g"]).collect()}
    assert inside == {r[0]: k + 1 for g in "ab" for k, r in enumerate(sorted((r for r in rows if r[2] == g), key=order))}
    tops = {r.hex_id for r in ranks.top_fraction(df, "v", 0.01, within=["g"]).collect()}
    assert tops == {r[0] for g in "ab" for r in sorted((r for r in rows if r[2] == g), key=order)[:5]}
    assert ranks.ordinal_ranks(df.limit(0), "v").count() == 0 and ranks.average_ranks(df.limit(0), "v").count() == 0


def test_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [("abc"[int(k)], float(v) if v > 1 else None) for k, v in zip(rng.integers(0, 3, 400), rng.integers(0, 40, 400), strict=True)]
    df = spark.createDataFrame([*rows, (None, 7.0), ("empty", None)], "g string, v double")
    got = {r.g: r for r in stats.percentiles(df, ["g"], "v").collect()}
    for g in ("a", "b", "c", None):
        values = [v for k, v in [*rows, (None, 7.0)] if k == g and v is not None]
        assert [got[g][name] for name in stats.POINTS] == pytest.approx([float(np.quantile(values, p)) for p in stats.POINTS.values()])
    assert "empty" not in got


@pytest.mark.parametrize("digits", [2, 3, 5])
def test_exact_round_equals_the_binary_value(spark, digits):
    rng = np.random.default_rng(digits)
    values = [*rng.uniform(-100, 100, 3000).tolist(), *(k / 8 for k in range(-40, 40)), *(k / 10**digits + 0.5 / 10**digits for k in range(-200, 200)), 2.675, 1.005, 0.125, -0.0, 0.0, 1e-12, -1e-12, 1e17, 4503599627370497.5]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for r in df.select("v", delivery.exact_round(digits)(F.col("v")).alias("r")).collect():
        assert r.r == (None if r.v is None else round(r.v, digits) + 0.0), r.v


def test_component_reader_refuses_bad_tables(spark, tmp_path):
    columns = {"hex_id": "string", "score": "double"}
    for name, rows in {"good": [("a", 1.0), ("b", 100.0)], "repeated": [("a", 1.0), ("a", 2.0)], "range": [("a", 101.0)], "missing": [("a", None)], "none": []}.items():
        spark.createDataFrame(rows, "hex_id string, score double").coalesce(1).write.option("header", True).csv(f"{tmp_path}/{name}")
        if name == "good":
            assert sorted(layers.read_component(spark, f"{tmp_path}/{name}", columns, "score", source="csv").collect()) == [("a", 1.0), ("b", 100.0)]
        elif rows:
            with pytest.raises(ValueError):
                layers.read_component(spark, f"{tmp_path}/{name}", columns, "score", source="csv")
    with pytest.raises(ValueError, match="lacks"):
        layers.read_component(spark, f"{tmp_path}/good", columns | {"more": "string"}, "score", source="csv")


def test_components_reject_flags_that_disagree(spark):
    ids = spark.createDataFrame([("a",), ("b",)], "hex_id string")
    flags = spark.createDataFrame([("a", True), ("b", False)], "hex_id string, boundary_edge_flag boolean")
    raw = spark.createDataFrame([("a", 0.0, 0.25, 0.0, 0, 0.5, 3.0, 0.1), ("b", 0.5, 1.0, 0.5, 2, 0.0, 1.0, 0.0)], "hex_id string, habitat_local_fraction double, opposing_balance_ratio double, riparian_focal_fraction double, nearest_protected_hex_steps int, protected_focal_fraction double, candidate_land_area_ha double, artificial_focal_fraction double")
    tables = {f: components.component(raw, flags, f) for f in scoring.FIELDS}
    got = {r.hex_id: [r[f] for f in scoring.FIELDS] for r in components.reconcile(ids, tables).collect()}
    assert got == {"a": [0.0, 25.0, 0.0, 100.0, 100.0], "b": [100.0, 100.0, 100.0, 50.0, 0.0]}
    tables[scoring.FIELDS[2]] = tables[scoring.FIELDS[2]].withColumn("boundary_edge_flag", F.lit(True))
    with pytest.raises(Exception, match="disagree"):
        components.reconcile(ids, tables).collect()
    with pytest.raises(Exception, match="outside"):
        components.component(raw.withColumn("opposing_balance_ratio", F.lit(1.5)), flags, scoring.FIELDS[1]).collect()


def test_nearest_crosses_missing_cells(spark):
    cand = spark.createDataFrame([("a", 0, 0), ("b", 1, 0), ("c", 0, 3), ("d", 200, -150)], "hex_id string, grid_col int, grid_row int")
    src = spark.createDataFrame([(0, 0)], "grid_col int, grid_row int")
    assert {r.hex_id: r.steps for r in neighbours.nearest_steps(cand, src).collect()} == {"a": 0, "b": 1, "c": 3, "d": 200}
    assert {r.steps for r in neighbours.nearest_steps(cand, src.limit(0)).collect()} == {None}


def test_neighbourhood_sums_pixels_first(spark):
    grid = [(0, 0, 100, 99), *[(c, r, 10, 100) for c, r in hexgrid.ring(1)], *[(c, r, 20, 100) for c, r in hexgrid.ring(2)]]
    g = spark.createDataFrame(grid, "grid_col int, grid_row int, part long, whole long")
    c = spark.createDataFrame([("f", 0, 0), ("far", 50, 50)], "hex_id string, grid_col int, grid_row int")
    got = {r.hex_id: (r.x_adjacent_fraction, r.x_local_fraction) for r in neighbours.share_indicators(c, g, "part", "whole", "x").collect()}
    assert got == {"f": (60 / 600, 300 / 1800), "far": (None, None)}


def test_weights_are_checked():
    with pytest.raises(ValueError):
        scoring.check_weights((0.5, 0.5, 0.5, 0.0, 0.0))


def test_join_rejects_repeated_keys(spark):
    a = spark.createDataFrame([("x",)], "hex_id string")
    b = spark.createDataFrame([("x", 1), ("x", 2)], "hex_id string, v int")
    with pytest.raises(Exception, match="not one row"):
        checks.one_to_one_join(a, b, ["v"]).collect()


def _rows(columns, rows):
    text = lambda x: "None" if x is None or x != x else repr(round(float(x), 9)) if isinstance(x, float) else str(x)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are missing")
@pytest.mark.parametrize("name", ["s2_eligible_cells", "s5_pixel_to_protection", "s5_network_indicators", "s3_nearest_protected", "s6_riparian_score", "s7_shortlists", "s8_explanations", "s6_leave_one_out", "s2_coverage_gate", "s3_context_filter", "s3_footprint_distance", "s4_adjacent_pairs", "s7_thematic_effect", "s8_delivery_frame", "s7_weight_index", "s3_grid_cells", "s5_water_only", "s7_churn_profiles", "s8_final_audit", "s3_overlaps", "s2_polygon_checks"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "part", "supplier", "orders", "customer", "nation"):
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    got = __spark_entry__.queries()[name](spark, DATA)
    want = con.sql(__spark_entry__.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got.columns, got.collect()) == _rows(want.columns, want.fetchall())
