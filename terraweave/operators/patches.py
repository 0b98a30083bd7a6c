"""Connected patches of a pixel mask, their areas and outlines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraweave.operators import runs as intervals
from terraweave.sources.storage import drop, materialise


def runs(mask: DataFrame, tile: int = 256) -> DataFrame:
    """(run, px_row, left, right): neighbouring pixels of a row, cut at every ``tile`` columns.

    mask: (px_col, px_row), or runs (px_row, left, right), which are never taken apart;
    repeated pixels count once. run: a number that grows by row
    and column. Groups are (row, tile) and hold at most ``tile`` pixels.
    """
    if "left" in mask.columns:
        # within a tile a stretch that begins where another ends belongs to it
        parts = intervals.joined(intervals.union(mask, strip=tile).withColumn("px_row", F.struct("px_row", F.floor(F.col("left") / F.lit(tile)).alias("t"))))
        return parts.select((F.col("px_row.px_row").cast("long") * F.lit(1 << 31) + F.col("left")).alias("run"), F.col("px_row.px_row").alias("px_row"), F.col("px_row.t").alias("t"), "left", "right")
    pixels = mask.select("px_row", "px_col").where("px_row is not null and px_col is not null").distinct().withColumn("t", F.floor(F.col("px_col") / F.lit(tile)))
    order = Window.partitionBy("px_row", "t").orderBy("px_col")
    grouped = pixels.withColumn("island", F.col("px_col") - F.row_number().over(order)).groupBy("px_row", "t", "island").agg(F.min("px_col").alias("left"), F.max("px_col").alias("right"))
    return grouped.select((F.col("px_row").cast("long") * F.lit(1 << 31) + F.col("left")).alias("run"), F.col("px_row").cast("int").alias("px_row"), "t", F.col("left").cast("int").alias("left"), F.col("right").cast("int").alias("right"))


TILE_ROWS = 256


def _inside(pdf: pd.DataFrame) -> pd.DataFrame:
    """Runs of one tile with ``part``, the smallest run that they reach inside the tile."""
    pdf = pdf.sort_values(["px_row", "left"], ignore_index=True)
    row, left, right = pdf["px_row"].tolist(), pdf["left"].tolist(), pdf["right"].tolist()
    root = list(range(len(pdf)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    below = 0
    for i in range(len(pdf)):
        while below < i and (row[below] < row[i] - 1 or (row[below] == row[i] - 1 and right[below] < left[i])):
            below += 1
        j = below
        while j < i and row[j] == row[i] - 1 and left[j] <= right[i]:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)  # the order of places is that of the runs' numbers
            j += 1
    pdf["part"] = pdf["run"].to_numpy()[[find(i) for i in range(len(pdf))]] if len(pdf) else pdf["run"]
    return pdf[["run", "px_row", "t", "left", "right", "part"]]


def _border_links(found: DataFrame, rows: int) -> DataFrame:
    """(a, b), a < b, distinct: parts that touch across the border of their tiles."""
    upper = found.where(F.pmod("px_row", F.lit(rows)) == 0).select(F.col("part").alias("v"), (F.col("px_row") - 1).alias("px_row"), "t", F.col("left").alias("l"), F.col("right").alias("r"))
    lower = found.where(F.pmod("px_row", F.lit(rows)) == rows - 1)
    across = lower.join(upper, ["px_row", "t"]).where("left <= r AND l <= right").select(F.col("part").alias("u"), "v")
    # runs that end at a cut meet the one that begins behind it
    ends, begins = found.select(F.col("part").alias("u"), "px_row", F.col("right").alias("at")), found.select(F.col("part").alias("v"), "px_row", (F.col("left") - 1).alias("at"))
    both = across.unionByName(ends.join(begins, ["px_row", "at"]).select("u", "v"))
    return both.where("u <> v").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def label(mask: DataFrame, max_rounds: int = 60, rows: int = TILE_ROWS) -> DataFrame:
    """(patch, px_row, left, right): the runs of ``mask`` with their patch, the smallest run reached by rook moves.

    Two levels: a tile's runs are put together in one task, whose size a tile bounds; then
    only parts that touch a tile's border are linked, and rounds go over those. Labels fall
    to the least label of a neighbour, hooked under the old label's own, and are then read
    off the label's label; long chains halve each round. Every round is a table in the
    shared folder, and only a count reaches the driver.
    """
    tiled = runs(mask).withColumn("tr", F.floor(F.col("px_row") / F.lit(rows)))
    found = materialise(tiled.groupBy("t", "tr").applyInPandas(_inside, "run long, px_row int, t long, left int, right int, part long"), "parts")
    links = materialise(_border_links(found, rows), "links")
    both = materialise(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    labels = materialise(both.select(F.col("a").alias("part"), F.col("a").alias("patch")).distinct(), "labels")
    for _ in range(max_rounds):
        of = lambda name, value: labels.select(F.col("part").alias(name), F.col("patch").alias(value))  # noqa: E731, B023
        met = materialise(both.join(of("a", "mine"), "a").join(of("b", "theirs"), "b").where("theirs < mine").groupBy("a", "mine").agg(F.min("theirs").alias("least")), "met")
        if met.isEmpty():
            break
        # the part takes the least label it meets, and so does the part that its old label names
        offers = met.select(F.col("a").alias("part"), "least").unionByName(met.select(F.col("mine").alias("part"), "least")).groupBy("part").agg(F.min("least").alias("least"))
        hooked = materialise(labels.join(offers, "part", "left").select("part", F.least("patch", F.coalesce("least", "patch")).alias("patch")), "hooked")
        was = [met, labels]
        labels = materialise(hooked.join(hooked.select(F.col("part").alias("patch"), F.col("patch").alias("root")), "patch").select("part", F.col("root").alias("patch")), "labels")
        for done in [*was, hooked]:
            drop(done)
    else:
        raise RuntimeError(f"patches did not settle in {max_rounds} rounds")
    return found.join(labels, "part", "left").select(F.coalesce("patch", "part").alias("patch"), "px_row", "left", "right")


def sizes(labelled: DataFrame, pixel_m2: float = 100.0) -> DataFrame:
    """(patch, pixels, area_m2, bounds): one row a patch."""
    return labelled.groupBy("patch").agg(
        F.sum(F.col("right") - F.col("left") + 1).cast("long").alias("pixels"), (F.sum(F.col("right") - F.col("left") + 1) * F.lit(pixel_m2)).alias("area_m2"),
        F.min("left").alias("min_col"), F.max("right").alias("max_col"), F.min("px_row").alias("min_row"), F.max("px_row").alias("max_row"),
    )


def sides(labelled: DataFrame) -> DataFrame:
    """(patch, x1, y1, x2, y2): sides of the patches in pixels, upright ones of length 1, level ones as long as they go inside a run.

    A level side lies where a run's pixels have none below (or above) them; an upright one
    at a run's end that no other run touches.
    """
    plain = labelled.select("px_row", "left", "right")
    shifted = lambda by: plain.select((F.col("px_row") + by).cast("int").alias("px_row"), "left", "right")

    def level(by: int, up: int) -> DataFrame:
        free = intervals.joined(intervals.difference(plain, shifted(by)))
        at = (F.col("px_row") + up).alias
        parts = intervals.overlaid(labelled, free)
        return parts.select("patch", F.col("left").alias("x1"), at("y1"), (F.col("right") + 1).alias("x2"), at("y2"))

    def upright(end: str, step: int) -> DataFrame:
        other = "right" if end == "left" else "left"
        beside = plain.select("px_row", (F.col(other) - step).alias(end))
        x = F.col("left") if end == "left" else F.col("right") + 1
        return labelled.join(beside, ["px_row", end], "left_anti").select("patch", x.alias("x1"), F.col("px_row").alias("y1"), x.alias("x2"), (F.col("px_row") + 1).alias("y2"))

    return level(1, 0).unionByName(level(-1, 1)).unionByName(upright("left", -1)).unionByName(upright("right", 1))


def outlines(labelled: DataFrame) -> DataFrame:
    """(patch, x1, y1, x2, y2): unit edges, in pixels, that belong to one pixel of the patch only: ``sides`` cut to unit length."""
    long = sides(labelled)
    unit = long.withColumn("x1", F.explode(F.sequence("x1", F.greatest("x2", F.col("x1") + 1) - 1)))
    return unit.select("patch", "x1", "y1", F.when(F.col("y1") == F.col("y2"), F.col("x1") + 1).otherwise(F.col("x1")).alias("x2"), "y2")


def accounting(patches: DataFrame, min_area_m2: float = 10_000.0) -> DataFrame:
    """One row: patches, mask area, those of at least ``min_area_m2``, their area and percent (null without a mask)."""
    kept = F.col("area_m2") >= min_area_m2
    out = patches.agg(F.count("*").alias("patches"), F.coalesce(F.sum("area_m2"), F.lit(0.0)).alias("mask_m2"), F.count_if(kept).alias("kept"), F.coalesce(F.sum(F.when(kept, F.col("area_m2"))), F.lit(0.0)).alias("kept_m2"))
    return out.withColumn("kept_percent", F.try_divide(F.col("kept_m2") * 100.0, F.col("mask_m2")))
