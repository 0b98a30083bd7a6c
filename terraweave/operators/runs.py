"""Algebra of runs of pixels: (px_row, left, right), both ends included.

Union, intersection, difference and areas never take a run apart into pixels. The ends of
the runs of all layers become events; in each row, cut into strips of columns so that a
crowded row is many groups, running sums of the events tell how often each layer covers
the stretch up to the next event. Events at one place are added up before they are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraweave.functions import hexgrid
from terraweave.sources.storage import materialise

STRIP = 4096  # columns


def _stripped(runs: DataFrame, strip: int) -> DataFrame:
    """``runs`` cut at the borders of strips, with the strip of each part."""
    usable = runs.where("px_row is not null and left <= right")
    index = lambda c: F.floor(F.col(c) / strip).cast("int")
    parts = usable.withColumn("_strip", F.explode(F.sequence(index("left"), index("right"))))
    return parts.withColumns({"left": F.greatest("left", F.col("_strip") * strip).cast("int"), "right": F.least("right", (F.col("_strip") + 1) * strip - 1).cast("int")})


def sweep(strip: int = STRIP, **layers: DataFrame) -> DataFrame:
    """(px_row, left, right, n_<layer>...): stretches along which the number of covering runs of each layer is constant.

    Only stretches that some layer covers are given; they are apart from each other, and
    cut at strips. Runs with a null or ``left`` behind ``right`` are dropped; a layer may
    cover a pixel several times; empty layers cover nothing.
    """
    names = list(layers)
    events = []
    for name in names:
        deltas = F.array(F.struct(F.col("left").alias("at"), F.lit(1).alias("d")), F.struct((F.col("right") + 1).alias("at"), F.lit(-1).alias("d")))
        ends = _stripped(layers[name], strip).select("px_row", "_strip", F.explode(deltas).alias("e"))
        events.append(ends.select("px_row", "_strip", "e.at", *[(F.col("e.d") if n == name else F.lit(0)).alias(n) for n in names]))
    places = reduce(DataFrame.unionByName, events).groupBy("px_row", "_strip", "at").agg(*[F.sum(n).alias(n) for n in names])
    row = Window.partitionBy("px_row", "_strip").orderBy("at")
    upto = row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = places.select("px_row", F.col("at").alias("left"), (F.lead("at").over(row) - 1).alias("right"), *[F.sum(n).over(upto).alias(f"n_{n}") for n in names])
    return placed.where(F.greatest(*[F.col(f"n_{n}") for n in names], F.lit(0)) > 0)


def joined(runs: DataFrame) -> DataFrame:
    """(px_row, left, right): runs that touch or overlap become one, across strips too."""
    row = Window.partitionBy("px_row").orderBy("left", "right")
    reached = F.max("right").over(row.rowsBetween(Window.unboundedPreceding, -1))
    opened = runs.select("px_row", "left", "right", F.coalesce((F.col("left") > reached + 1).cast("int"), F.lit(0)).alias("_new"))
    return opened.withColumn("_run", F.sum("_new").over(row)).groupBy("px_row", "_run").agg(F.min("left").alias("left"), F.max("right").alias("right")).drop("_run")


def _where(condition: Column, strip: int, **layers: DataFrame) -> DataFrame:
    return sweep(strip, **layers).where(condition).select("px_row", "left", "right")


def union(first: DataFrame, second: DataFrame | None = None, strip: int = STRIP) -> DataFrame:
    """Pixels of either table, once, as runs apart from each other (cut at strips; ``joined`` makes them whole)."""
    both = first.select("px_row", "left", "right")
    return _where(F.col("n_a") > 0, strip, a=both if second is None else both.unionByName(second.select("px_row", "left", "right")))


def intersection(first: DataFrame, second: DataFrame, strip: int = STRIP) -> DataFrame:
    return _where((F.col("n_a") > 0) & (F.col("n_b") > 0), strip, a=first, b=second)


def difference(first: DataFrame, second: DataFrame, strip: int = STRIP) -> DataFrame:
    return _where((F.col("n_a") > 0) & (F.col("n_b") == 0), strip, a=first, b=second)


def pixels_in(condition: Column) -> Column:
    """Aggregate: pixels of the stretches that meet a condition."""
    return F.coalesce(F.sum(F.when(condition, F.col("right") - F.col("left") + 1)), F.lit(0)).cast("long")


def union_areas(first: DataFrame, second: DataFrame, pixel_m2: float = 100.0) -> DataFrame:
    """One row: areas of both unions, of their union and intersection, their sum, and whether \\|A or B\\| = \\|A\\| + \\|B\\| - \\|A and B\\|; one shuffle of run ends."""
    a, b = F.col("n_a") > 0, F.col("n_b") > 0
    areas = {"first_m2": a, "second_m2": b, "intersection_m2": a & b, "union_m2": a | b}
    out = sweep(a=first, b=second).agg(*[(pixels_in(c) * F.lit(pixel_m2)).alias(n) for n, c in areas.items()])
    return out.withColumn("summed_m2", F.col("first_m2") + F.col("second_m2"))


def overlaid(coded: DataFrame, mask: DataFrame, strip: int = STRIP) -> DataFrame:
    """``coded`` (px_row, left, right and other columns) cut to ``mask``, whose runs lie apart: an equality on row and strip, then overlap."""
    right = _stripped(mask.select("px_row", "left", "right"), strip).select(F.col("px_row").alias("_row"), F.col("_strip").alias("_s"), F.col("left").alias("_left"), F.col("right").alias("_right"))
    met = _stripped(coded, strip).join(right, (F.col("px_row") == F.col("_row")) & (F.col("_strip") == F.col("_s")) & (F.col("left") <= F.col("_right")) & (F.col("_left") <= F.col("right")))
    return met.withColumns({"left": F.greatest("left", "_left"), "right": F.least("right", "_right")}).select(*coded.columns)


def code_counts(coded: DataFrame) -> DataFrame:
    """(code, pixels) from coded runs."""
    return coded.groupBy("code").agg(F.sum(F.col("right") - F.col("left") + 1).cast("long").alias("pixels"))


def to_cells(runs: DataFrame) -> DataFrame:
    """(px_row, left, right, grid_col, grid_row): runs cut where the hexagon cell changes.

    With e the height of a row of pixels above the middle of its cell row, in cell rows,
    a cell changes once a width on its upright sides (abs(e) <= 1/3) and twice on its
    slanted ones. Rounding may move a change by a pixel, so the pixel there is a part of its own, and
    every part asks the grid's own function for the cell of its first pixel.
    """
    r = (F.col("px_row") + 0.5) * 10.0 / F.lit(1.5 * hexgrid.SIDE)
    runs = runs.select("px_row", "left", "right", r.alias("_r"), (r - F.rint(r)).alias("_e"))
    q = lambda c: (F.col(c) + 0.5) * 10.0 / F.lit(hexgrid.WIDTH) - F.col("_r") / 2.0
    units = F.sequence(F.floor(q("left")) - 2, F.ceil(q("right")) + 2)
    e = F.col("_e")
    upright, slanted = (1.0 - e) / 2.0, [e, -2.0 * e]
    changes = F.filter(F.array(F.when(F.abs(e) < 0.34, upright), *[F.when(F.abs(e) > 0.33, x) for x in slanted]), lambda x: x.isNotNull())
    column = lambda x: F.rint((x + F.col("_r") / 2.0) * F.lit(hexgrid.WIDTH / 10.0) - 0.5).cast("int")
    places = F.flatten(F.transform(units, lambda k: F.flatten(F.transform(changes, lambda x: F.array(column(k + x), column(k + x) + 1)))))
    inside = F.filter(places, lambda c: (c > F.col("left")) & (c <= F.col("right")))
    cut = runs.withColumn("_cuts", F.array_sort(F.array_distinct(F.concat(F.array(F.col("left")), inside))))
    ends = F.transform("_cuts", lambda c, i: F.struct(c.alias("left"), F.coalesce(F.get("_cuts", i + 1) - 1, F.col("right")).alias("right")))
    parts = cut.select("px_row", F.explode(ends).alias("p")).select("px_row", "p.left", "p.right")
    placed = parts.withColumns({"_x": (F.col("left") + 0.5) * F.lit(10.0), "_y": (F.col("px_row") + 0.5) * F.lit(10.0)})
    return hexgrid.with_cell(placed, "_x", "_y").drop("_x", "_y")


def cell_counts(runs: DataFrame) -> DataFrame:
    """(grid_col, grid_row, pixels) of runs that lie apart, written once.

    A join on the cell has Spark filter its columns for nulls, and the filter would go down to every part of
    a run and repeat the grid's function there, in a method of over 8,000 bytes, which the JVM leaves uncompiled.
    """
    counts = to_cells(runs).groupBy("grid_col", "grid_row").agg(F.sum(F.col("right") - F.col("left") + 1).cast("long").alias("pixels"))
    return materialise(counts, "cell-counts")
