"""CSV, JSON and cell-table sinks in Spark's own writers; paths may be in any store that Spark writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, decimals: int = 10) -> None:
    """Doubles as fixed-point text with ``decimals`` places, NaN where missing; other nulls are empty."""
    fixed = lambda c: F.when(F.col(c).isNull() | F.isnan(c), "NaN").otherwise(F.format_string(f"%.{decimals}f", F.col(c)))
    df.select(*[fixed(c).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]).write.mode("overwrite").csv(path, header=True)


def write_audit(df: DataFrame, path: str) -> None:
    """One JSON object a row; values that aren't finite become null, nulls are written."""
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c))
    clean = df.select(*[finite(c).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])
    clean.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_features(features: DataFrame, path: str) -> None:
    """(hex_id, feature) as newline-delimited GeoJSON, in the order of the id."""
    features.repartitionByRange("hex_id").sortWithinPartitions("hex_id").select("feature").write.mode("overwrite").text(path)
