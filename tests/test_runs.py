"""Algebra of runs against sets of pixels, and cells of runs against cells of pixels."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.operators import raster, runs

SCHEMA = "px_row int, left int, right int, n_a string"


def made(seed, n=120, rows=6, columns=300):
    rng = np.random.default_rng(seed)
    left = rng.integers(-columns, columns, n)
    return [(int(r), int(a), int(a + w), "clash") for r, a, w in zip(rng.integers(0, rows, n), left, rng.integers(0, 60, n), strict=True)]


def pixels(rows):
    return {(r, c) for r, a, b, *_ in rows if r is not None and a is not None and b is not None for c in range(a, b + 1)}


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("strip", [16, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_algebra_equals_sets(spark, strip, seed):
    a, b = made(seed), made(seed + 10, n=60)
    ta, tb = table(spark, a), table(spark, b)
    for found, want in ((runs.union(ta, tb, strip), pixels(a) | pixels(b)), (runs.union(ta, strip=strip), pixels(a)), (runs.intersection(ta, tb, strip), pixels(a) & pixels(b)), (runs.difference(ta, tb, strip), pixels(a) - pixels(b))):
        got = [(r.px_row, r.left, r.right) for r in found.collect()]
        assert pixels(got) == want and sum(c - b + 1 for _, b, c in got) == len(want)  # apart from each other
        whole = [(r.px_row, r.left, r.right) for r in runs.joined(found).collect()]
        assert pixels(whole) == want and not any((r, x + 1) in want for r, _, x in whole)
    row = runs.union_areas(ta, tb).first()
    sizes = [100.0 * len(x) for x in (pixels(a), pixels(b), pixels(a) & pixels(b), pixels(a) | pixels(b))]
    assert [row.first_m2, row.second_m2, row.intersection_m2, row.union_m2] == sizes and row.summed_m2 == sizes[0] + sizes[1]


def test_depths_and_codes(spark):
    a, mask = made(5), made(6, n=40)
    depth = {}
    for r, x, y, _ in a:
        for c in range(x, y + 1):
            depth[r, c] = depth.get((r, c), 0) + 1
    got = {(r.px_row, c): r.n_a for r in runs.sweep(32, a=table(spark, a)).collect() for c in range(r.left, r.right + 1)}
    assert got == depth
    apart = [(r, c, c + 3, "clash") for r in range(6) for c in range(-300, 300, 4)]
    coded = table(spark, apart).withColumn("code", F.pmod(F.col("left"), F.lit(7)))
    want = {}
    for r, x, y, _ in apart:
        for c in range(x, y + 1):
            if (r, c) in pixels(mask):
                want[x % 7] = want.get(x % 7, 0) + 1
    assert {r.code: r.pixels for r in runs.code_counts(runs.overlaid(coded, runs.union(table(spark, mask)), 64)).collect()} == want


def test_cells_of_runs_equal_cells_of_pixels(spark):
    """Every height in a cell row, negative coordinates, runs of one pixel and of many cells."""
    rows = [(r, -313, 911, "x") for r in range(-60, 120)] + [(r, 40003, 40003, "x") for r in range(620000, 620100)] + [(r, 41111, 41400, "x") for r in range(620100, 620200)]
    df = table(spark, rows)
    each = df.select("px_row", F.explode(F.sequence("left", "right")).alias("px_col"))
    each = hexgrid.with_cell(each.withColumns({"x": (F.col("px_col") + 0.5) * F.lit(10.0), "y": (F.col("px_row") + 0.5) * F.lit(10.0)}))
    want = sorted(map(tuple, each.groupBy("grid_col", "grid_row").count().collect()))
    assert sorted(map(tuple, runs.cell_counts(df).collect())) == want
    assert runs.to_cells(df).count() * 8 < sum(b - a + 1 for _, a, b, _ in rows)  # runs, not pixels


def test_edges(spark):
    bad = table(spark, [(None, 1, 2, "x"), (1, None, 2, "x"), (1, 5, 4, "x"), (1, 2, None, "x")])
    some = table(spark, [(1, 0, 9, "x"), (1, 0, 9, "x")])
    assert runs.union(bad).count() == 0 and runs.intersection(bad, some).count() == 0
    assert [tuple(r) for r in runs.difference(some, bad).collect()] == [(1, 0, 9)]
    assert runs.union_areas(bad, some).first().union_m2 == 1000.0 and runs.union_areas(bad, bad).first().union_m2 == 0.0
    assert runs.cell_counts(bad.limit(0)).count() == 0


def test_dissolve_is_never_by_pixel(spark):
    """The plan of a union of polygons' runs has no row a pixel: its rows are run ends."""
    square = spark.createDataFrame([(k, *e) for k in range(5) for e in ((0.3, 0.3, 4000.3, 0.3), (4000.3, 0.3, 4000.3, 4000.3), (4000.3, 4000.3, 0.3, 4000.3), (0.3, 4000.3, 0.3, 0.3))], "feature_id int, x1 double, y1 double, x2 double, y2 double")
    spans = raster.spans(square)
    assert runs.union(spans).count() == 400 and runs.union(spans).agg(F.sum(F.col("right") - F.col("left") + 1)).first()[0] == 160_000


def flood(cells):
    """Patches by rook moves, each as a set."""
    left, out = set(cells), []
    while left:
        todo, patch = [left.pop()], set()
        while todo:
            r, c = todo.pop()
            patch.add((r, c))
            for near in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if near in left:
                    left.remove(near)
                    todo.append(near)
        out.append(patch)
    return out


@pytest.mark.parametrize("rows", [3, 256])
def test_patches_of_runs_in_two_levels(spark, rows):
    """Random runs, negative rows, and one spiral that passes through all tiles many times."""
    from terraweave.operators import patches

    made_rows = [(r - 7, a, b, x) for r, a, b, x in made(3, n=90, rows=20, columns=700)]
    spiral = [(2000 + k, 0 if k % 4 else 0, 600, "x") for k in range(0, 40, 2)] + [(2001 + k, 600 if k % 4 == 0 else 0, 600 if k % 4 == 0 else 0, "x") for k in range(0, 38, 2)]
    mask = [*made_rows, *spiral]
    found = patches.label(table(spark, mask), rows=rows).collect()
    got = {}
    for r in found:
        got.setdefault(r.patch, set()).update((r.px_row, c) for c in range(r.left, r.right + 1))
    want = flood(pixels(mask))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want))
    assert all(min((r << 31) + c for r, c in p) <= k for k, p in got.items())
    # level sides and upright ones add up to the pixels' own sides
    labelled = patches.label(table(spark, mask), rows=rows)
    sides = patches.sides(labelled).withColumn("n", F.col("x2") - F.col("x1") + F.col("y2") - F.col("y1"))
    cells = pixels(mask)
    assert sides.agg(F.sum("n")).first()[0] == sum((r + a, c + b) not in cells for r, c in cells for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1)))


def test_rounds_see_border_parts_only(spark, monkeypatch):
    """Patches that stay inside their tiles have no part in any round."""
    from terraweave.operators import patches

    seen = {}
    keep = patches.materialise

    def counted(df, name):
        out = keep(df, name)
        seen.setdefault(name, out.count())
        return out

    monkeypatch.setattr(patches, "materialise", counted)
    mask = table(spark, [(r, 256 * t + 10, 256 * t + 60, "x") for t in range(4) for r in range(5, 100)] + [(300, 250, 260, "x")])
    assert patches.label(mask).select("patch").distinct().count() == 5
    assert seen["links"] == 1 and seen["labels"] == 2


def test_cell_counts_are_compiled_behind_a_join(spark):
    """Before, the join's filter for nulls repeated the grid's function in a method of over 8,000 bytes, which the JVM leaves uncompiled."""
    pixels = spark.createDataFrame([(620010, 40000, 40120)], "px_row int, left int, right int")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans have no code before they run
    try:
        counted = runs.cell_counts(pixels)
        plan = counted.select("grid_col", "grid_row").hint("merge").join(counted, ["grid_col", "grid_row"])
        text = plan._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
        assert 0 < max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
