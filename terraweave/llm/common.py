"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraweave.sources.storage import drop, materialise

__all__ = ["drop", "id_remainder", "materialise", "table"]

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % modulus
