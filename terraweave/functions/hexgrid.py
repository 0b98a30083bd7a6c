"""Hexagon grid as column expressions.

Cells are 500 m wide (flat to flat) with axial coordinates (grid_col, grid_row):
x = (col + row / 2) * width, y = row * 1.5 * side, side = width / sqrt(3).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 500.0
SIDE = WIDTH / math.sqrt(3.0)


def hex_id(col: Column, row: Column) -> Column:
    return F.concat(F.lit("h_"), col.cast("string"), F.lit("_"), row.cast("string"))


def centre(col: Column, row: Column) -> tuple[Column, Column]:
    return (col + row / F.lit(2.0)) * F.lit(WIDTH), row * F.lit(1.5 * SIDE)


def with_cell(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """``points`` with grid_col and grid_row: cube rounding, halves to even."""
    r = F.col(y) / F.lit(1.5 * SIDE)
    q = F.col(x) / F.lit(WIDTH) - F.col("_r") / F.lit(2.0)
    out = points.withColumn("_r", r).withColumn("_q", q).withColumn("_s", -F.col("_q") - F.col("_r"))
    out = out.withColumns({"_rq": F.rint("_q"), "_rr": F.rint("_r"), "_rs": F.rint("_s")})
    dq, dr, ds = F.abs(F.col("_rq") - F.col("_q")), F.abs(F.col("_rr") - F.col("_r")), F.abs(F.col("_rs") - F.col("_s"))
    col = F.when((dq > dr) & (dq > ds), -F.col("_rr") - F.col("_rs")).otherwise(F.col("_rq"))
    row = F.when((dq > dr) & (dq > ds), F.col("_rr")).when(dr > ds, -F.col("_rq") - F.col("_rs")).otherwise(F.col("_rr"))
    return out.withColumns({"grid_col": col.cast("int"), "grid_row": row.cast("int")}).drop("_r", "_q", "_s", "_rq", "_rr", "_rs")


def distance(col_a: Column, row_a: Column, col_b: Column, row_b: Column) -> Column:
    dc, dr = col_a - col_b, row_a - row_b
    return F.greatest(F.abs(dc), F.abs(dr), F.abs(dc + dr))


def ring(radius: int) -> list[tuple[int, int]]:
    """Axial offsets at exactly ``radius`` steps."""
    steps = range(-radius, radius + 1)
    return [(c, r) for c in steps for r in steps if max(abs(c), abs(r), abs(c + r)) == radius]


def polygon(col: Column, row: Column) -> Column:
    """Array of six (x, y) corners at 30, 90, ... degrees, rounded to 9 decimals."""
    x, y = centre(col, row)
    corners = [(math.cos(math.radians(30 + 60 * i)), math.sin(math.radians(30 + 60 * i))) for i in range(6)]
    return F.array(*[F.struct(F.round(x + F.lit(SIDE * c), 9).alias("x"), F.round(y + F.lit(SIDE * s), 9).alias("y")) for c, s in corners])
