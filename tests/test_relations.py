"""Distances, patches and pairs against brute force, and sinks read back."""

import json
import random
import re

import pytest

from terraweave.operators import audits, geometry, neighbours, patches
from terraweave.sources import sinks

EDGE = "{} string, x1 double, y1 double, x2 double, y2 double"


def _ring(key, points):
    return [(key, *map(float, a), *map(float, b)) for a, b in zip(points, [*points[1:], points[0]], strict=True)]


def _box(key, x, y, r):
    return _ring(key, [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r)])


def _patches(mask):
    left, out = set(mask), []
    while left:
        todo, patch = [left.pop()], set()
        while todo:
            c, r = todo.pop()
            patch.add((c, r))
            for near in ((c + 1, r), (c - 1, r), (c, r + 1), (c, r - 1)):
                if near in left:
                    left.remove(near)
                    todo.append(near)
        out.append(patch)
    return out


def _mask(rng):
    snake = [(c, 40) for c in range(600)] + [(599, r) for r in range(40, 60)] + [(c, 60) for c in range(0, 600)]
    return snake + [(rng.randrange(60), rng.randrange(30)) for _ in range(900)]


def test_patches_match_a_flood_fill(spark):
    mask = _mask(random.Random(3))
    labelled = patches.label(spark.createDataFrame([*mask, (None, 3)], "px_col int, px_row int")).cache()
    want = _patches(mask)
    got = {}
    for row in labelled.collect():
        got.setdefault(row.patch, set()).update((c, row.px_row) for c in range(row.left, row.right + 1))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))
    assert sorted(r.pixels for r in patches.sizes(labelled).collect()) == sorted(map(len, want))
    sides = sum(((c + dc, r + dr) not in p) for p in want for c, r in p for dc, dr in ((1, 0), (-1, 0), (0, 1), (0, -1)))
    assert patches.outlines(labelled).count() == sides


def test_patches_of_nothing(spark):
    empty = spark.createDataFrame([], "px_col int, px_row int")
    row = patches.accounting(patches.sizes(patches.label(empty))).first()
    assert (row.patches, row.mask_m2, row.kept_percent) == (0, 0.0, None)


def test_distances_inside_holding_and_limits(spark):
    shapes = [*_box("inside", 0, 0, 1), *_box("holding", 500, 500, 50), *_box("edge", 0, 110, 5), *_box("beyond", 0, 110.001, 5), *_box("crossing", 100, 0, 10)]
    others = [*_box("big", 0, 0, 100), *_box("small", 500, 500, 1)]
    a, b = spark.createDataFrame([*shapes, ("null", None, 1.0, 1.0, 1.0)], EDGE.format("hex_id")), spark.createDataFrame(others, EDGE.format("feature_id"))
    got = {r.hex_id: r.distance for r in geometry.distances(a, b, 5.0).collect()}
    assert got == {"inside": 0.0, "holding": 0.0, "edge": 5.0, "crossing": 0.0}
    assert geometry.distances(a, b.limit(0), 5.0).count() == 0


def test_nearest_points_match_brute_force(spark):
    rng = random.Random(5)
    triangles = [(f"t{i}", [(x, y), (x + rng.uniform(1, 400), y + rng.uniform(-50, 50)), (x + rng.uniform(-50, 50), y + rng.uniform(1, 300))]) for i, (x, y) in enumerate((rng.uniform(-5e3, 5e3), rng.uniform(-5e3, 5e3)) for _ in range(25))]
    points = [(f"p{i}", rng.uniform(-2e4, 2e4), rng.uniform(-2e4, 2e4)) for i in range(60)] + [(f"in{i}", sum(x for x, _ in t) / 3, sum(y for _, y in t) / 3) for i, (_, t) in enumerate(triangles)]

    def gap(x, y, ring):
        best, inside = 1e18, False
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
            t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            best = min(best, ((x - ax - t * (bx - ax)) ** 2 + (y - ay - t * (by - ay)) ** 2) ** 0.5)
            inside ^= (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay)
        return 0.0 if inside else best

    edges = spark.createDataFrame([e for k, ring in triangles for e in _ring(k, ring)], EDGE.format("feature_id"))
    found = geometry.nearest(spark.createDataFrame([(k, x, y, x, y) for k, x, y in points], EDGE.format("hex_id")), edges, start=300.0)
    got = {r.hex_id: r.distance for r in found.collect()}
    assert got == pytest.approx({k: min(gap(x, y, ring) for _, ring in triangles) for k, x, y in points}, abs=1e-6)


def test_nearest_of_far_sources(spark):
    """Before, a round's tiles grew until one held all shapes and others, and beyond 8,192 km the distance was null."""
    rng = random.Random(8)
    points = [(f"p{i}", x0 + rng.uniform(-9e3, 9e3), rng.uniform(-3e7, 3e7)) for i, x0 in enumerate([0.0, 4e5, -2e7] * 20)] + [("none", None, 0.0)]
    sides = [(i, x, y, x + rng.uniform(-300, 300), y + rng.uniform(-300, 300)) for i, (x, y) in enumerate((rng.uniform(-7e3, 7e3), rng.choice([-4e7, 0, 9e6]) + rng.uniform(-4e4, 4e4)) for _ in range(90))]
    shapes = spark.createDataFrame([(k, x, y, x, y) for k, x, y in points], EDGE.format("hex_id"))
    others = spark.createDataFrame(sides, "feature_id int, x1 double, y1 double, x2 double, y2 double")

    def gap(x, y, ax, ay, bx, by):
        t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        return ((x - ax - t * (bx - ax)) ** 2 + (y - ay - t * (by - ay)) ** 2) ** 0.5

    got = {r.hex_id: r.distance for r in geometry.nearest(shapes, others).collect()}
    assert got.pop("none") is None
    assert got == pytest.approx({k: min(gap(x, y, *e[1:]) for e in sides) for k, x, y in points if x is not None}, abs=1e-6)
    assert max(got.values()) > 1e7
    assert {r.distance for r in geometry.nearest(shapes, others.limit(0)).collect()} == {None}


def test_pairs_of_tiles_grow_with_the_tiles(spark):
    """4,000 shapes in a line, 4,000 others in a line 9,000 km further: a few pairs a tile, not all of them."""
    line = lambda key, off: spark.range(4000).selectExpr(f"id AS {key}", "0D AS low_x", "0D AS high_x", f"2000D * (id + {off}) AS low_y", f"2000D * (id + {off}) AS high_y", "0L AS tx", f"id + {off} AS ty")
    pairs = geometry.near_tiles(line("a", -7), line("b", 4500))
    assert pairs.count() == pairs.select("tx", "ty").distinct().count() == 4000 and pairs.select("_ty").distinct().collect() == [(4500,)]


def test_steps_to_far_sources(spark):
    """Before, tiles doubled until one held all candidates and sources; here a round of that kind is followed by the hierarchy."""
    rng = random.Random(6)
    cells = [(f"h{i}", rng.choice([0, -9000, 70000]) + rng.randrange(40), rng.randrange(-200000, 200000)) for i in range(60)]
    sources = [(rng.randrange(-30, 30), rng.choice([-300000, 0, 90000]) + rng.randrange(300)) for _ in range(80)]
    got = neighbours.nearest_steps(spark.createDataFrame(cells, "hex_id string, grid_col int, grid_row int"), spark.createDataFrame(sources, "grid_col int, grid_row int"), max_rounds=1)
    want = {k: min(max(abs(c - a), abs(r - b), abs(c - a + r - b)) for a, b in sources) for k, c, r in cells}
    assert {r.hex_id: r.steps for r in got.collect()} == want
    tiles = lambda off: spark.range(2000).selectExpr(f"0L AS tx", f"id + {off} AS ty", "0D AS low_x", "15D AS high_x", f"16D * (id + {off}) AS low_y", f"16D * (id + {off}) + 15 AS high_y")
    assert geometry.near_tiles(tiles(-7), tiles(9000), neighbours._axial).count() <= 4 * 2000


def test_distances_are_compiled(spark):
    """Before, the distance of two segments was one nested expression, taken twice a pair in a method of over 8,000 bytes, which the JVM leaves uncompiled."""
    edges = spark.createDataFrame(_box("b", 0, 0, 1), EDGE.format("feature_id"))
    cells = edges.withColumnRenamed("feature_id", "hex_id")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans have no code before they run
    try:
        for plan in (geometry.distances(cells, edges, 5.0), geometry.near_boundary(cells.selectExpr("hex_id", "x1 x", "y1 y"), edges, 5.0)):
            text = plan._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
            assert 0 < max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_boundary_flag_is_inclusive(spark):
    points = spark.createDataFrame([("near", 450.0, 50.0), ("at", 1000.0, 500.0), ("far", 5050.0, 5050.0)], "hex_id string, x double, y double")
    edges = spark.createDataFrame(_ring("s", [(0.0, 0.0), (9000.0, 0.0), (9000.0, 9000.0), (0.0, 9000.0)]), EDGE.format("feature_id"))
    assert {r.hex_id: r.boundary_edge_flag for r in geometry.near_boundary(points, edges).collect()} == {"near": True, "at": True, "far": False}


def test_version_texts(spark):
    edges = [(i, v, 0.0, 0.0, 0.0, 100.0) for i, v in enumerate(["v2.1", "Version 2", "v1.9", "12", None])]
    edges += [(i, v, 50.0, 0.0, 50.0, 100.0) for i, v, *_ in edges]
    pixels = spark.createDataFrame([(2, 2, 3), (7, 2, 3), (8, 2, 61)], "px_col int, px_row int, code int")
    schema = "feature_id int, version string, x1 double, y1 double, x2 double, y2 double"
    row = audits.coverage(pixels, spark.createDataFrame(edges, schema)).first()
    assert (row.valid_pixels, row.land_pixels, row.uncovered_land, row.uncovered_marine, row.complete) == (3, 2, 1, 1, False)
    assert audits.coverage(pixels, spark.createDataFrame(edges, schema).where("version = 'v1.9'")).first().uncovered_land == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 0.5, 1), ("a", None, None), ("c", float("inf"), 2)], "hex_id string, v double, n int")
    sinks.write_csv(df.where("hex_id <> 'c'"), f"{tmp_path}/csv")
    lines = {line for f in (tmp_path / "csv").glob("part-*") for line in f.read_text().splitlines()}
    assert lines == {"hex_id,v,n", "b,0.5000000000,1", "a,NaN,"}
    sinks.write_audit(df, f"{tmp_path}/json")
    rows = [json.loads(line) for f in (tmp_path / "json").glob("part-*") for line in f.read_text().splitlines()]
    assert {r["hex_id"]: r["v"] for r in rows} == {"b": 0.5, "a": None, "c": None}
    sinks.write_features(spark.createDataFrame([("b", "{2}"), ("a", "{1}")], "hex_id string, feature string"), f"{tmp_path}/geo")
    assert "".join(f.read_text() for f in sorted((tmp_path / "geo").glob("part-*"))) == "{1}\n{2}\n"
