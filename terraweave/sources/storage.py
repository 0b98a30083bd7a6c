"""Tables written once in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting to remove the shuffle files of a query when it has ended.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see, from ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder serves local mode only; on a
    cluster that is an error, since executors would not see the driver's disk.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
    return _local_dir


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor costs a reread, not a recomputation. Nothing reads the
    shuffles of ``df`` once it is written, so they go then; the table goes when the driver
    ends.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._materialised_at = path
    return out


def drop(materialised: DataFrame) -> None:
    """Remove a table of ``materialise`` that nothing reads any more."""
    _remove(materialised.sparkSession, materialised._materialised_at)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    except Exception:  # the JVM may be gone at exit; the folder is scratch space
        pass
