"""Tiled tables and published versions."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraweave.operators import raster
from terraweave.sources import publish, tiles


def files_read(df):
    """Files that the scans of an executed plan have read."""
    def walk(node):
        name, metrics = node.nodeName(), node.metrics()
        own = metrics.apply("numFiles").value() if "Scan parquet" in name and metrics.contains("numFiles") else 0
        below = []
        if name.startswith("AdaptiveSparkPlan"):
            below = [node.executedPlan()]
        elif "QueryStage" in name:
            below = [node.plan()]
        else:
            children = node.children()
            below = [children.apply(i) for i in range(children.size())]
        return own + sum(map(walk, below))

    return walk(df._jdf.queryExecution().executedPlan())


def test_morton_interleaves_bits(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 1 << 24, (200, 2))] + [(0, 0), ((1 << 24) - 1, 0), (0, (1 << 24) - 1)]
    rows = spark.createDataFrame(pairs, "a long, b long").select("a", "b", tiles.morton(F.col("a"), F.col("b")).alias("m")).collect()
    assert all(r.m == sum(((r.a >> k & 1) << 2 * k) | ((r.b >> k & 1) << 2 * k + 1) for k in range(24)) for r in rows)


def test_clip_reads_touched_tiles_only(spark, tmp_path):
    pixels = spark.range(128 * 128).selectExpr("cast(id % 128 - 64 as int) as px_col", "cast(floor(id / 128) - 64 as int) as px_row", "cast(id % 7 as int) as code", "'x' as tile")
    path = str(tmp_path / "tiled")
    tiles.write_tiled(pixels.unionByName(pixels.limit(1).withColumn("px_col", F.lit(None).cast("int"))), path, tile=16)
    table = tiles.read_tiled(spark, path, "px_col int, px_row int, code int")
    assert table.count() == 128 * 128 and table.select("tile").distinct().count() == 64
    spans = spark.createDataFrame([(r, -20, -3) for r in range(3, 9)], "px_row int, left int, right int")
    assert tiles.touched_tiles(spans, 16).count() == 2
    got = tiles.clip_tiled(table, spans, 16)
    rows = got.select("px_col", "px_row", "code").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, raster.clip_to_spans(pixels, spans).select("px_col", "px_row", "code").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    whole = len([f for f in table.inputFiles()])
    again = tiles.clip_tiled(table, spans, 16)
    again._jdf.queryExecution().executedPlan().executeCollect()
    assert files_read(again) < whole / 8
    assert tiles.clip_tiled(table, spans.limit(0), 16).count() == 0


def test_published_versions(spark, tmp_path):
    path = str(tmp_path / "frame")
    df = spark.createDataFrame([(3, None, 1.5), (1, "a", None), (2, "b", 0.0), (2, "b", 0.0)], "k int, s string, v double")
    first = publish.publish(df, path, ["k", "s"])
    assert first["version"] == 1 and first["rows"] == 4
    assert [r.k for r in publish.read_published(spark, path, verify=True).collect()] == [1, 2, 2, 3]
    # the digest doesn't depend on order or parts, but on every value
    assert publish.digest(df.repartition(7).orderBy(F.desc("k"))) == publish.digest(df) != publish.digest(df.dropDuplicates())
    assert publish.digest(df.withColumn("s", F.coalesce("s", F.lit("")))) != publish.digest(df)
    assert publish.digest(df.limit(0)) == {"rows": 0, "digest": "0"}
    # a write that fails on its way leaves the published version
    broken = df.withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        publish.publish(broken, path)
    assert publish.versions(spark, path) == [1] and publish.read_published(spark, path, verify=True).count() == 4
    for n in (2, 3):
        publish.publish(df.withColumn("k", F.lit(n)), path)
    assert publish.versions(spark, path) == [2, 3] and publish.read_published(spark, path, 2).first().k == 2
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, path, 1)
    with pytest.raises(ValueError):  # rows that differ each time can't be vouched for
        changing = F.udf(lambda: time.time_ns(), "long").asNondeterministic()
        publish.publish(spark.range(50).withColumn("r", changing()), path)
    assert publish.versions(spark, path) == [2, 3]
    with pytest.raises(FileNotFoundError):
        publish.read_manifest(spark, str(tmp_path / "nothing"))
