"""Metrics from run logs, read as lines spread over all tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Log line patterns by metric name, each with the number as its first group.
LOG_PATTERNS = {
    "records": r"Records accepted:\s+(\d+)",
    "throughput": r"ETL Throughput:\s+~?([\d.]+)",
    "etl_seconds": r"Spark Streaming ETL:\s+~?([\d.]+)s",
}
# Fixed value: output size with its unit.
SIZE_PATTERN = r"Curated Parquet:\s+([\d.]+)([KMG])"
# Sweep sections with their marker and row pattern. The named
# groups are the swept parameter and the error reported for it.
SWEEPS = {
    "epsilon": ("[B] Sweeping Privacy Budgets", r"^\s*([\d.]+)\s*\|\s*([\d.]+)\s*$", (1, 2)),
    "cms_width": ("[C] Sweeping CMS Width", r"^\s*(\d+)\s*\|\s*(\d+)\s*\|\s*([\d.]+)\s*$", (1, 3)),
}


FILE = "_metadata.file_path"


def read_log_lines(spark: SparkSession, *paths: str, source: Column | str = FILE) -> DataFrame:
    """Lines with their source, by default their file, and a position that grows along it.

    A source of several files is read in the order of their names.
    """
    block, row = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    position = F.struct(F.col("_metadata.file_name").alias("file"), block.alias("block"), row.alias("row"))
    source = F.col(source) if isinstance(source, str) else source
    return spark.read.text(list(paths)).select(source.alias("source"), position.alias("position"), F.col("value").alias("line"))


def _number(pattern: str, group: int = 1) -> Column:
    return F.regexp_extract("line", pattern, group).try_cast("double")


def megabytes(pattern: str = SIZE_PATTERN) -> Column:
    unit = F.regexp_extract("line", pattern, 2)
    factor = F.when(unit == "K", F.lit(1 / 1024)).when(unit == "M", F.lit(1.0)).when(unit == "G", F.lit(1024.0))
    return _number(pattern) * factor


def run_metrics(lines: DataFrame) -> DataFrame:
    """First value of every metric per source; null where the log has none."""
    values = {name: _number(pattern) for name, pattern in LOG_PATTERNS.items()}
    values["parquet_mb"] = megabytes()
    found = lines.select("source", "position", *[value.alias(name) for name, value in values.items()])
    return found.groupBy("source").agg(
        *[
            F.min(F.when(F.col(name).isNotNull(), F.struct("position", F.col(name).alias("v"))))["v"].alias(name)
            for name in values
        ]
    )


def sweep_rows(lines: DataFrame, sweep: str) -> DataFrame:
    """Table rows that follow the sweep's section marker in the same source."""
    marker, pattern, (parameter, error) = SWEEPS[sweep]
    starts = lines.filter(F.col("line").contains(marker)).groupBy("source").agg(F.min("position").alias("start"))
    return (
        lines.filter(F.col("line").rlike(pattern))
        .join(starts, "source")
        .filter(F.col("position") > F.col("start"))
        .select("source", _number(pattern, parameter).alias("parameter"), _number(pattern, error).alias("error"))
    )
