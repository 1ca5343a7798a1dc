"""File sources and sinks: raw CSV, curated Parquet, reports and JSON exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaynet.schema import RAW_COLUMNS
from delaynet.session import materialize


def read_raw_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw records from one or many files, columns matched by header name.

    Paths may hold different columns in different orders; the files behind one
    path must share a header, which `enforceSchema` verifies. `source_file`
    tells where a row came from.
    """
    frames = []
    for path in paths:
        frame = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False)
        present = set(frame.columns)
        columns = [(F.col(name) if name in present else F.lit(None).cast("string")).alias(name) for name in RAW_COLUMNS]
        frames.append(frame.select(*columns, F.col("_metadata.file_path").alias("source_file")))
    return reduce(DataFrame.unionByName, frames)


CORRUPT_LINE = "malformed_line"


def read_checked_csv(spark: SparkSession, *paths: str, header: bool = True) -> DataFrame:
    """`read_raw_csv` with the whole line where it does not have as many fields as its file's columns, null elsewhere.

    `position` orders the lines of a file. Files without a header hold RAW_COLUMNS in order.
    """
    frames = []
    for path in paths:
        names = spark.read.csv(path, header=True, inferSchema=False).columns if header else RAW_COLUMNS
        schema = ", ".join(f"`{name}` STRING" for name in [*names, CORRUPT_LINE])
        # whole lines are parsed, as a line is malformed whatever columns are asked for
        reader = spark.read.option("columnPruning", "false")
        frame = reader.csv(
            path, schema=schema, header=header, enforceSchema=not header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT_LINE
        )
        columns = [(F.col(name) if name in names else F.lit(None).cast("string")).alias(name) for name in RAW_COLUMNS]
        position = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
        frames.append(frame.select(*columns, F.col("_metadata.file_path").alias("source_file"), position.alias("position"), CORRUPT_LINE))
    return reduce(DataFrame.unionByName, frames)


def ingest_csv(spark: SparkSession, quarantine: str, *paths: str, header: bool = True) -> DataFrame:
    """Well-formed raw records; malformed lines are appended to the quarantine table with file and position.

    The files are read once: both parts come from the written rows.
    """
    rows = materialize(read_checked_csv(spark, *paths, header=header), "csv")
    aside = rows.filter(F.col(CORRUPT_LINE).isNotNull())
    aside.select("source_file", "position", F.col(CORRUPT_LINE).alias("raw")).write.mode("append").parquet(quarantine)
    return rows.filter(F.col(CORRUPT_LINE).isNull()).drop("position", CORRUPT_LINE)


def write_raw_csv(raw: DataFrame, path: str) -> None:
    raw.write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="")


def append_curated(rows: DataFrame, path: str) -> None:
    """Append to the curated table, dropping rows without an airport."""
    rows.na.drop(subset=["origin", "destination"]).write.mode("append").parquet(path)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_results(tables: dict[str, DataFrame], folder: str) -> None:
    """Replace one Parquet table per entry under `folder`."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def write_report(rows: DataFrame, path: str, order: list, limit: int) -> None:
    """The first `limit` rows in `order` as a single CSV file with a header.

    Ordering with a limit keeps only `limit` rows per task, so the one file
    written at the end is small whatever the input size.
    """
    rows.orderBy(*order).limit(limit).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_json_records(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)
