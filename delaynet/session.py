"""Session settings and the shared scratch folder for written intermediates."""

from __future__ import annotations

import atexit
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Every setting here is ordinary Spark configuration; a cluster's own
# spark-defaults may override any of them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


_USED: set[str] = set()
_TABLES: set[str] = set()  # bucketed tables that the catalog knows


def build_session(app: str = "delaynet", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, or else the warehouse.

    A warehouse on this machine serves local sessions only; on a cluster it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_scratch"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/delaynet/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, inside the shared folder."""
    folder = _own_folder(spark)
    if folder not in _USED:
        _USED.add(folder)
        atexit.register(_release_at_exit, folder)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove all intermediates of this application. Results that read them are then gone as well."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    _remove(spark, _own_folder(spark))


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _release_at_exit(folder: str) -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and SparkContext._active_spark_context is not None:
        release(spark)
        _remove(spark, folder)


def bucketed(df: DataFrame, label: str, buckets: int, *keys: str) -> DataFrame:
    """Write `df` once in buckets by its keys and read it back.

    A join on these keys with as many partitions reads the table where it lies,
    without moving it. One task writes each bucket, as one file.
    """
    name = f"{label}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", scratch_path(df.sparkSession, label))
    writer.saveAsTable(name)
    _TABLES.add(name)
    return df.sparkSession.table(name)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back.

    Cuts lineage for iterative jobs and for results used several times. A
    written table survives lost executors, and its size on disk is what the
    optimizer then uses to decide on broadcasts.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
