"""Polygons to pixels, clipping and coverage, over edge tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def spans(edges: DataFrame, step: float = 10.0, keys: tuple[str, ...] = ("feature_id",)) -> DataFrame:
    """(keys, px_row, left, right): runs of pixels whose centres lie inside, by scanline.

    edges: (keys, x1, y1, x2, y2) of closed rings, holes included (even-odd rule). Pixel
    (c, r) has its centre at ((c + 0.5) * step, (r + 0.5) * step). An edge covers the rows
    from its lower end (included) to its upper end (excluded), and a row's crossings pair
    up from the left, left end included, so shared borders belong to one side only.
    Groups are (feature, row), however large the polygon. Null coordinates are dropped;
    horizontal edges and empty tables give nothing.
    """
    half = step / 2
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = F.ceil((low - half) / step), F.ceil((high - half) / step) - 1
    rows = edges.where("x1 is not null and x2 is not null and y1 is not null and y2 is not null").where(first <= last)
    rows = rows.withColumn("px_row", F.explode(F.sequence(first, last)))
    y = F.col("px_row") * F.lit(step) + F.lit(half)
    x = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossings = rows.groupBy(*keys, "px_row").agg(F.sort_array(F.collect_list(x)).alias("xs"))
    runs = crossings.withColumn("i", F.explode(F.sequence(F.lit(0), F.floor(F.size("xs") / 2) - 1))).where("i >= 0")
    left, right = F.ceil((F.get("xs", F.col("i") * 2) - half) / step), F.ceil((F.get("xs", F.col("i") * 2 + 1) - half) / step) - 1
    runs = runs.select(*keys, F.col("px_row").cast("int").alias("px_row"), left.cast("int").alias("left"), right.cast("int").alias("right"))
    return runs.where("left <= right")


def rasterise(edges: DataFrame, step: float = 10.0, keys: tuple[str, ...] = ("feature_id",)) -> DataFrame:
    """(keys, px_col, px_row): the runs of ``spans`` pixel by pixel."""
    return spans(edges, step, keys).select(*keys, F.explode(F.sequence("left", "right")).alias("px_col"), "px_row")


def merged(runs: DataFrame) -> DataFrame:
    """(px_row, left, right): the runs of all features as their union, apart from each other.

    The runs of one row are merged together; a row has as many as features cross it.
    """
    row = Window.partitionBy("px_row").orderBy("left", "right")
    reached = F.max("right").over(row.rowsBetween(Window.unboundedPreceding, -1))
    opened = runs.select("px_row", "left", "right", F.coalesce((F.col("left") > reached + 1).cast("int"), F.lit(0)).alias("_new"))
    return opened.withColumn("_run", F.sum("_new").over(row)).groupBy("px_row", "_run").agg(F.min("left").alias("left"), F.max("right").alias("right")).drop("_run")


def clip_to_spans(pixels: DataFrame, runs: DataFrame) -> DataFrame:
    """Pixels inside any run, by an equality on the row and a range test in the column.

    A large polygon costs one run a row instead of one row a pixel.
    """
    mask = runs.select(F.col("px_row").alias("_row"), "left", "right")
    return pixels.join(mask, (F.col("px_row") == F.col("_row")) & F.col("px_col").between(F.col("left"), F.col("right")), "left_semi")


def clip_to_ring(pixels: DataFrame, corners: list[tuple[float, float]], step: float = 10.0) -> DataFrame:
    """Pixels inside one ring of few corners, by the rules of ``spans`` and without a join.

    The sides are constants of the query: a pixel is inside if an odd number of those that
    cross its row have their first pixel at or before its column.
    """
    half, crossed = step / 2, F.lit(0)
    y = F.col("px_row") * F.lit(step) + F.lit(half)
    for (x1, y1), (x2, y2) in zip(corners, [*corners[1:], corners[0]], strict=True):
        first, last = math.ceil((min(y1, y2) - half) / step), math.ceil((max(y1, y2) - half) / step) - 1
        if first <= last:
            x = F.lit(x1) + (y - F.lit(y1)) * F.lit(x2 - x1) / F.lit(y2 - y1)
            crossed = crossed + (F.col("px_row").between(first, last) & (F.ceil((x - half) / step) <= F.col("px_col"))).cast("int")
    return pixels.where(crossed % 2 == 1)


def block_masks(runs: DataFrame, size: int = 5) -> DataFrame:
    """(bx, by, mask): runs as bits of square blocks of ``size`` pixels (at most 5): pixel (i, j) of a block is bit j * size + i.

    One row for every run and block; ``bit_or`` unites them.
    """
    index = lambda c: F.floor(F.col(c) / size)
    parts = runs.where("px_row is not null and left <= right").withColumn("bx", F.explode(F.sequence(index("left"), index("right")))).withColumn("by", index("px_row"))
    return parts.selectExpr(
        "bx", "by", f"shiftleft(shiftleft(1, CAST(least(right - bx * {size}, {size - 1}) + 1 AS INT)) - shiftleft(1, CAST(greatest(left - bx * {size}, 0) AS INT)), CAST((px_row - by * {size}) * {size} AS INT)) AS mask"
    )


def buffered(edges: DataFrame, distance: float, step: float = 10.0) -> DataFrame:
    """(px_row, left, right): runs of pixels whose centres lie inside the rings or at most ``distance`` from a side.

    The rings' own runs, and for every side those of the rectangle around it and of the
    discs at its ends; runs overlap. ``runs.union`` takes them together.
    """
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length = F.sqrt(dx * dx + dy * dy)
    usable = edges.where("x1 is not null and x2 is not null and y1 is not null and y2 is not null").select("x1", "y1", "x2", "y2").distinct()
    named = usable.withColumn("feature_id", F.xxhash64("x1", "y1", "x2", "y2")).withColumns({"_nx": F.try_divide(-dy, length) * F.lit(distance), "_ny": F.try_divide(dx, length) * F.lit(distance)})
    corner = lambda e, side: F.struct((F.col(f"x{e}") + F.col("_nx") * side).alias("x"), (F.col(f"y{e}") + F.col("_ny") * side).alias("y"))
    ring = [corner(1, 1), corner(2, 1), corner(2, -1), corner(1, -1)]
    sides = F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)])
    boxes = named.select("feature_id", F.explode(sides).alias("s")).select("feature_id", F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))
    ends = usable.select(F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p")).select("p.*").distinct()
    half, d = step / 2, F.lit(distance)
    rows = ends.withColumn("px_row", F.explode(F.sequence(F.ceil((F.col("y") - d - half) / step), F.floor((F.col("y") + d - half) / step))))
    up = F.col("px_row") * F.lit(step) + F.lit(half) - F.col("y")
    reach = F.sqrt(F.greatest(d * d - up * up, F.lit(0.0)))
    discs = rows.select(F.col("px_row").cast("int").alias("px_row"), F.ceil((F.col("x") - reach - half) / step).cast("int").alias("left"), F.floor((F.col("x") + reach - half) / step).cast("int").alias("right"))
    own = spans(edges, step)
    return own.select("px_row", "left", "right").unionByName(spans(boxes, step).select("px_row", "left", "right")).unionByName(discs.where("left <= right"))


def dissolve(pixels: DataFrame) -> DataFrame:
    """Physical union: every pixel once, whichever features cover it."""
    return pixels.select("px_col", "px_row").distinct()


def clip(pixels: DataFrame, mask: DataFrame) -> DataFrame:
    return pixels.join(mask.select("px_col", "px_row"), ["px_col", "px_row"], "left_semi")


def code_statistics(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("code").agg(F.count("*").alias("pixels"))
