"""Pixel tables clustered by square tiles, and clips that read only the tiles they touch.

A tile's number interleaves the bits of its column and row (Morton order), so tiles that
are near in the plane are near in the table. The table is partitioned by tile; inside a
tile pixels are sorted, so Parquet's statistics narrow the rows as well. A clip turns the
runs of its mask into the tiles they cross, and Spark prunes the partitions by these while the query
runs, as long as they are few enough to be broadcast; beyond that the join still holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.operators import raster
from terraweave.sources.storage import materialise

TILE = 256  # pixels
_HALF = 1 << 23  # a tile's column and row lie in [-_HALF, _HALF)


def morton(column: Column, row: Column) -> Column:
    """One number from two whole ones below 2**24: their bits in turn, the column's last."""

    def spread(v: Column) -> Column:
        v = v.cast("long")
        # each step moves the upper half of every group of bits away by the group's size
        for size in (16, 8, 4, 2, 1):
            mask = sum(((1 << size) - 1) << at for at in range(0, 48, 2 * size))
            v = v.bitwiseOR(F.shiftleft(v, size)).bitwiseAND(F.lit(mask).cast("long"))
        return v

    return spread(column).bitwiseOR(F.shiftleft(spread(row), 1))


def tile_of(px_col: Column, px_row: Column, tile: int = TILE) -> Column:
    return morton(F.floor(px_col / F.lit(tile)) + _HALF, F.floor(px_row / F.lit(tile)) + _HALF)


def write_tiled(pixels: DataFrame, path: str, tile: int = TILE) -> None:
    """``pixels`` (px_col, px_row, ...) partitioned by tile and sorted by row and column inside.

    Parts are ranges of (tile, row, column), so a crowded tile is several files. Pixels
    without a place are dropped; a column named ``tile`` is replaced; an empty table gives an empty folder.
    """
    placed = pixels.where("px_col is not null and px_row is not null").withColumn("tile", tile_of(F.col("px_col"), F.col("px_row"), tile))
    order = ["tile", "px_row", "px_col"]
    placed.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("tile").mode("overwrite").parquet(path)


def read_tiled(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """The table at ``path``; columns: its schema as DDL, without the tile."""
    return spark.read.schema(f"{columns}, tile long").parquet(path)


def touched_tiles(spans: DataFrame, tile: int = TILE) -> DataFrame:
    """(tile), distinct: tiles that the runs (px_row, left, right) cross. Runs of a row of tiles are put together before they are spread out."""
    index = lambda c: F.floor(F.col(c) / tile)
    rows = spans.groupBy(index("px_row").alias("tr"), index("left").alias("first"), index("right").alias("last")).agg(F.count("*").alias("_n"))
    cells = rows.select("tr", F.explode(F.sequence("first", "last")).alias("tc"))
    return cells.select(morton(F.col("tc") + _HALF, F.col("tr") + _HALF).alias("tile")).distinct()


def clip_tiled(table: DataFrame, spans: DataFrame, tile: int = TILE) -> DataFrame:
    """Pixels of a tiled ``table`` inside the runs; partitions of other tiles aren't read."""
    touched = materialise(touched_tiles(spans, tile), "tiles").where("tile >= 0")
    return raster.clip_to_spans(table.join(touched, "tile", "left_semi"), spans)
