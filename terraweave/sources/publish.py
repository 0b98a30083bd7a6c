"""Tables published at once: written aside, checked against a manifest, then named by one rename.

``path/versions/<id>`` holds the parts, ``path/manifest-<n>.json`` says which version is
the n-th, with its rows and a digest that doesn't depend on the order or the number of parts. A
manifest is written under another name and renamed, which a reader sees wholly or not at
all. A write that fails on its way leaves the versions before it as they were.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = re.compile(r"manifest-(\d{8})\.json$")
DIGEST = "rows long, digest decimal(38,0)"


def digest(df: DataFrame) -> dict:
    """{rows, digest}: the sum of a 64-bit hash of every row, equal for any order and partitioning; repeated rows count."""
    named: list[Column] = [F.col(c) for c in sorted(df.columns)]
    # a marker for each null keeps (null, x) and (x, null) apart
    marked = [x for c in named for x in (c.isNull(), c)]
    row = df.agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*marked).cast("decimal(20,0)")).alias("digest")).first()
    return {"rows": row["rows"], "digest": str(row["digest"] or 0)}


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, in order."""
    store, at = _store(spark, path)
    if not store.exists(at(path)):
        return []
    names = [f.getPath().getName() for f in store.listStatus(at(path))]
    return sorted(int(m[1]) for m in map(_MANIFEST.search, names) if m)


def publish(df: DataFrame, path: str, order: list[str] | None = None, keep: int = 2) -> dict:
    """Write ``df`` as the next version of ``path`` and return its manifest.

    order: columns by which parts are ranges and rows are sorted inside them. What was
    written is read back and its digest compared with that of ``df`` before it is named. All but the
    last ``keep`` versions are removed then. Two writers of one path at a time: the second
    rename fails and raises, as the manifest is there already.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    target = f"{path}/versions/{name}"
    sorted_parts = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    sorted_parts.write.parquet(target)
    written = digest(spark.read.schema(df.schema).parquet(target))
    store, at = _store(spark, path)
    if written != digest(df):
        store.delete(at(target), True)
        raise ValueError(f"{path}: what was written differs from the table, which may not give the same rows twice")
    number = (versions(spark, path) or [0])[-1] + 1
    manifest = {"version": number, "parts": f"versions/{name}", "schema": df.schema.simpleString(), **written}
    aside, final = f"{path}/_{name}.json", f"{path}/manifest-{number:08d}.json"
    out = store.create(at(aside), True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if store.exists(at(final)) or not store.rename(at(aside), at(final)):
        store.delete(at(aside), False)
        store.delete(at(target), True)
        raise FileExistsError(final)
    for old in versions(spark, path)[:-keep]:
        parts = read_manifest(spark, path, old)["parts"]
        store.delete(at(f"{path}/manifest-{old:08d}.json"), False)
        store.delete(at(f"{path}/{parts}"), True)
    return manifest


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{path} has no version {version or ''}".strip())
    number = known[-1] if version is None else version
    return json.loads("".join(r.value for r in spark.read.text(f"{path}/manifest-{number:08d}.json").collect()))


def read_published(spark: SparkSession, path: str, version: int | None = None, verify: bool = False) -> DataFrame:
    """The newest (or a given) version; ``verify`` compares its digest with the manifest's first."""
    manifest = read_manifest(spark, path, version)
    df = spark.read.parquet(f"{path}/{manifest['parts']}")
    if verify and digest(df) != {k: manifest[k] for k in ("rows", "digest")}:
        raise ValueError(f"{path}: version {manifest['version']} isn't what was published")
    return df
