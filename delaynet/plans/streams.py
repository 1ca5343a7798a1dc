"""Stream runs over messages written from the input tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delaynet.schema import FLIGHT_COLUMNS, MESSAGE_DDL
from delaynet.session import scratch_path
from delaynet.sources.messages import file_stream
from delaynet.sources.tables import spread, table
from delaynet.streaming import bloom_ingest as bloom_stream
from delaynet.streaming import ingest as ingest_stream

FILES_PER_BATCH = 4
# Row groups of message files: a batch of few files is read by as many tasks as there are cores.
ROW_GROUP_BYTES = 4 << 20
# Deliveries up to this year are there when the stream first starts; the others
# come while it is stopped, and are taken in by a second run.
FIRST_RUN_UNTIL = 1995


@dataclass
class IngestRun:
    curated: DataFrame
    rejected: DataFrame
    audit: DataFrame
    messages: DataFrame


def _sent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per lineitem row, so repeated (order, line) keys arrive again.

    Rows without a discount are cut off on the way; low-priority lines shipped
    in an even year have no origin, so an id may come unrouted first and whole
    later, or the other way round.
    """
    line, order = spread(table(spark, sf_dir, "lineitem"), "l_orderkey"), table(spark, sf_dir, "orders")
    no_origin = (F.col("o_orderpriority") == "5-LOW") & (F.year("l_shipdate") % 2 == 0)
    rows = line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("flight_id"),
        F.lit("").alias("tail_number"),
        F.col("l_linenumber").alias("flight_number"),
        F.when(~no_origin, F.col("o_orderpriority")).alias("origin"),
        F.col("o_orderstatus").alias("destination"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00")).alias("scheduled_departure"),
        F.pmod(F.floor("o_totalprice"), F.lit(300)).cast("int").alias("delay_minutes"),
        F.lit("nas").alias("delay_cause"),
        (F.col("l_discount") == 0).alias("cut"),
        F.year("l_shipdate").alias("delivery"),
    )
    sent = rows.withColumn("value", F.to_json(F.struct(*FLIGHT_COLUMNS)))
    whole = F.encode("value", "utf-8")
    cut = F.encode(F.concat(F.lit('{"flight_id":"'), "flight_id"), "utf-8")
    return sent.select(
        F.concat(F.lit("flight-"), "flight_id").alias("key"), F.when(F.col("cut"), cut).otherwise(whole).alias("value"), "delivery"
    )


def _backdate(spark: SparkSession, path: str) -> None:
    """Give the last delivery's files time stamps that are a month old."""
    system = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = sorted(str(f.getPath()) for f in system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(path)) if f.isDirectory())
    old = int(time.time() * 1000) - 30 * 24 * 3600 * 1000
    for file in system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folders[-1])) if folders else []:
        system.setTimes(file.getPath(), old, -1)


def deliver(spark: SparkSession, sf_dir: str, path: str, rows: Column) -> None:
    """Messages as files, one folder per delivery year. Rebalancing splits a year
    that holds most rows into several files of even size, and row groups let many
    tasks read one file."""
    sent = _sent_lines(spark, sf_dir).filter(rows).hint("rebalance", "delivery")
    sent.write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("delivery").parquet(path)


def _in_two_runs(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery]) -> DataFrame:
    """Run a stream to the end of what is there, deliver the rest, and run it again. Returns all messages."""
    path = scratch_path(spark, "messages")
    for rows in (F.col("delivery") <= FIRST_RUN_UNTIL, F.col("delivery") > FIRST_RUN_UNTIL):
        deliver(spark, sf_dir, path, rows)
        _backdate(spark, path)
        start(file_stream(ingest_stream.stream_session(spark), path, FILES_PER_BATCH)).awaitTermination()
    return spark.read.schema(MESSAGE_DDL).option("recursiveFileLookup", "true").parquet(path)


def _result(spark: SparkSession, output: str, messages: DataFrame) -> IngestRun:
    return IngestRun(
        curated=ingest_stream.read_ingested(spark, f"{output}/curated"),
        rejected=ingest_stream.read_ingested(spark, f"{output}/rejected"),
        audit=ingest_stream.read_audit(spark, f"{output}/audit"),
        messages=messages,
    )


def ingest(spark: SparkSession, sf_dir: str) -> IngestRun:
    output = scratch_path(spark, "ingested")
    places = [f"{output}/{name}" for name in ("curated", "rejected", "audit", "checkpoint")]
    messages = _in_two_runs(spark, sf_dir, lambda messages: ingest_stream.start_ingest(messages, *places))
    return _result(spark, output, messages)


def bloom_ingest(spark: SparkSession, sf_dir: str, growth: bloom_stream.Growth = bloom_stream.Growth()) -> IngestRun:
    """The same messages with approximate deduplication."""
    output = scratch_path(spark, "bloom")
    places = [f"{output}/{name}" for name in ("curated", "rejected", "audit", "filters", "checkpoint")]
    messages = _in_two_runs(spark, sf_dir, lambda messages: bloom_stream.start_bloom_ingest(messages, *places, growth))
    return _result(spark, output, messages)


def whole_ids(spark: SparkSession, sf_dir: str, messages: DataFrame) -> DataFrame:
    """Ids that come whole and routed at least once, in the messages or among the lines
    without a day, which no delivery takes."""
    undelivered = _sent_lines(spark, sf_dir).filter("delivery is null")
    sent = messages.select("value").unionByName(undelivered.select("value"))
    rows = ingest_stream.classified(sent.withColumn("position", F.lit("")))
    return rows.filter("reason is null").select("flight_id").distinct()
