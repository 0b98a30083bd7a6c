"""Partners inside a sliding band of scores: for each row the highest and lowest value among rows whose score is little larger.

Rows are numbered once in (score, id) order. A row's band is then a run of numbers that
begins behind it. Runs are answered as range extremes over blocks of equal size: inside a
block from its array, over whole blocks from a table of extremes over 1, 2, 4, ... blocks,
and all rows of one block whose bands end alike share one answer. So no join meets more than a
block's rows at a key, even where most rows have one score, and no window holds a score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraweave.operators import ranks
from terraweave.sources.storage import materialise


def band_ends(numbered: DataFrame, width: float, name: str = "band-ends") -> DataFrame:
    """(_row, _last): the number of the last row whose score is at most ``width`` above that of row ``_row``.

    numbered: (_row from 0 in score order, _s). Rows and the ends of their bands are sorted
    together, rows first where equal; a band's end is the count of the rows before it.
    """
    both = numbered.select(F.col("_s").alias("_at"), F.lit(0).alias("_kind"), "_row").unionByName(numbered.select((F.col("_s") + F.lit(width)).alias("_at"), F.lit(1).alias("_kind"), "_row"))
    placed = ranks._sorted(both, ["_at", "_kind", "_row"], name)
    is_row = F.when(F.col("_kind") == 0, 1).otherwise(0)
    starts = ranks._starts(placed.groupBy("_part").agg(F.sum(is_row).alias("_size")))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = placed.withColumn("_inside", F.sum(is_row).over(inside)).join(starts, "_part")
    return counted.where("_kind = 1").select("_row", (F.col("_start") + F.col("_inside") - 1).cast("long").alias("_last"))


def _extremes(high: Column, low: Column) -> list[Column]:
    return [F.max(high).alias("high"), F.min(low).alias("low")]


def _block_table(blocks: DataFrame, n_blocks: int) -> DataFrame:
    """(level, block, high, low): extremes over the 2**level blocks from ``block`` on; as many levels as the logarithm of the blocks."""
    level = materialise(blocks.select(F.lit(0).alias("level"), "block", "high", "low"), "band-level")
    out, k = level, 0
    while 2 << k <= n_blocks:
        right = level.select((F.col("block") - (1 << k)).alias("block"), F.col("high").alias("_high"), F.col("low").alias("_low"))
        level = level.join(right, "block").select(F.lit(k + 1).alias("level"), "block", F.greatest("high", "_high").alias("high"), F.least("low", "_low").alias("low"))
        level = materialise(level, "band-level")
        out, k = out.unionByName(level), k + 1
    return out


def band_extremes(df: DataFrame, score: str, value: str, width: float, id_col: str = "hex_id", block: int = 128) -> DataFrame:
    """(_row, id, _s, _v, high_row, low_row): numbers of the rows with the highest and the lowest value in each row's band.

    The band of a row are the rows after it in (score, id) order whose score is at most
    ``width`` larger; of equal values the first one counts. Rows with an empty band have
    null partners. Null or NaN scores and values take no part; ids should be unique. An empty table gives no rows.
    """
    usable = " and ".join(f"{c} is not null and not isnan({c})" for c in ("_s", "_v"))
    slim = df.select(id_col, F.col(score).cast("double").alias("_s"), F.col(value).cast("double").alias("_v")).where(usable)
    placed = ranks._sorted(slim, ["_s", id_col], "band-rows")
    starts = ranks._starts(placed.groupBy("_part").agg(F.count("*").alias("_size")))
    rows = placed.join(starts, "_part").select((F.col("_start") + F.col("_place")).cast("long").alias("_row"), id_col, "_s", "_v")
    index = lambda c: F.floor(F.col(c) / block)
    rows = rows.join(band_ends(rows.select("_row", "_s"), width), "_row").withColumn("_first_block", F.floor((F.col("_row") + 1) / block)).withColumn("_last_block", index("_last"))
    rows = materialise(rows, "band-spans")
    # of equal values the first row is both the highest and the lowest
    high, low = F.struct(F.col("_v").alias("v"), (-F.col("_row")).alias("r")), F.struct(F.col("_v").alias("v"), F.col("_row").alias("r"))
    cells = F.array_sort(F.collect_list(F.struct(F.col("_row").alias("r"), F.col("_v").alias("v"))))
    blocks = materialise(rows.groupBy(index("_row").alias("block")).agg(cells.alias("cells"), *_extremes(high, low)), "band-blocks")
    n_blocks = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    part_high = lambda x: F.array_max(F.transform(x, lambda c: F.struct(c["v"].alias("v"), (-c["r"]).alias("r"))))
    part_low = lambda x: F.array_min(F.transform(x, lambda c: F.struct(c["v"].alias("v"), c["r"].alias("r"))))
    # the own block, from the row on to its end or the band's end; a row's first block may lie past the last
    held = blocks.select(F.col("block").alias("_first_block"), "cells")
    until = F.least(F.col("_last"), (F.col("_first_block") + 1) * block - 1)
    own = F.slice("cells", (F.col("_row") + 1 - F.col("_first_block") * block + 1).cast("int"), F.greatest(until - F.col("_row"), F.lit(0)).cast("int"))
    mine = rows.join(held, "_first_block", "left").withColumn("_own", own).select(*rows.columns, part_high("_own").alias("_h0"), part_low("_own").alias("_l0"))
    # what lies beyond the own block: one answer for all rows of a block whose bands end alike
    beyond = rows.where("_last_block > _first_block").select("_first_block", "_last_block", "_last").distinct()
    last = F.slice("cells", F.lit(1), (F.col("_last") - F.col("_last_block") * block + 1).cast("int"))
    tails = beyond.select("_last", "_last_block").distinct().join(blocks.select(F.col("block").alias("_last_block"), "cells"), "_last_block").select("_last", part_high(last).alias("_h1"), part_low(last).alias("_l1"))
    table = _block_table(blocks, n_blocks)
    count = F.col("_last_block") - F.col("_first_block") - 1
    level = F.when(count > 0, F.floor(F.log2(F.greatest(count, F.lit(1)).cast("double")) + F.lit(1e-9))).cast("int")
    asked = beyond.withColumn("level", level).withColumn("_from", F.col("_first_block") + 1).withColumn("_to", F.col("_last_block") - F.expr("shiftleft(1L, coalesce(level, 0))"))
    side = lambda at, n: table.select("level", F.col("block").alias(at), F.col("high").alias(f"_h{n}"), F.col("low").alias(f"_l{n}"))
    asked = asked.join(side("_from", 2), ["level", "_from"], "left").join(side("_to", 3), ["level", "_to"], "left").join(tails, "_last")
    answers = asked.select("_first_block", "_last", F.greatest("_h1", F.coalesce("_h2", "_h1"), F.coalesce("_h3", "_h1")).alias("_hb"), F.least("_l1", F.coalesce("_l2", "_l1"), F.coalesce("_l3", "_l1")).alias("_lb"))
    met = mine.join(answers, ["_first_block", "_last"], "left")
    best = F.greatest(F.coalesce("_h0", "_hb"), F.coalesce("_hb", "_h0"))
    worst = F.least(F.coalesce("_l0", "_lb"), F.coalesce("_lb", "_l0"))
    return met.select("_row", id_col, "_s", "_v", (-best["r"]).alias("high_row"), worst["r"].alias("low_row"), best["v"].alias("_high"), worst["v"].alias("_low"))


def contrast_pairs(df: DataFrame, score: str, value: str, width: float = 2.0, n: int = 5, id_col: str = "hex_id", block: int = 128) -> DataFrame:
    """(place, first_id, second_id, first_score, second_score, score_gap, first_value, second_value, difference): the ``n`` largest contrasts at nearly one score.

    Each row meets the rows of the highest and the lowest value in its band (see
    ``band_extremes``); pairs of equal values don't count. Ties go to the smaller first id, then to the higher value.
    """
    found = materialise(band_extremes(df, score, value, width, id_col, block), "band-partners")
    options = F.array(F.struct(F.lit(0).alias("kind"), F.col("high_row").alias("partner"), F.col("_high").alias("v")), F.struct(F.lit(1).alias("kind"), F.col("low_row").alias("partner"), F.col("_low").alias("v")))
    pairs = found.select(id_col, "_s", "_v", F.explode(options).alias("o")).where(F.col("o.v") != F.col("_v"))
    pairs = pairs.select(F.col(id_col).alias("first_id"), F.col("_s").alias("first_score"), F.col("_v").alias("first_value"), "o.kind", "o.partner", F.abs(F.col("o.v") - F.col("_v")).alias("difference"))
    # the same partner twice means all values of the band are equal: the first mention counts
    order = [F.desc("difference"), F.col("first_id"), F.col("kind")]
    top = pairs.orderBy(*order).limit(2 * n).groupBy("first_id", "partner", "first_score", "first_value", "difference").agg(F.min("kind").alias("kind"))
    top = top.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))).where(F.col("place") <= n)  # at most 2 n rows
    second = found.select(F.col("_row").alias("partner"), F.col(id_col).alias("second_id"), F.col("_s").alias("second_score"), F.col("_v").alias("second_value"))
    out = second.join(F.broadcast(top), "partner")
    return out.select("place", "first_id", "second_id", "first_score", "second_score", (F.col("second_score") - F.col("first_score")).alias("score_gap"), "first_value", "second_value", "difference")
