"""Message stream to curated Parquet: decode, deduplicate, quarantine, account.

Deduplication is exact and its state lives in the query's checkpoint, so a restart
neither loses it nor lets old ids back in. The dedup clock is the time of the batch
that first sees a message. It only moves forward, whatever time stamps a message or
file carries, so no first delivery is ever late. Messages that cannot be read or
have no route are set aside before deduplication: they hold no state, and do not
stand in the way of a whole delivery of the same id.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delaynet.operators import bloom
from delaynet.schema import FLIGHT_COLUMNS
from delaynet.sources.messages import CORRUPT, decode_json, is_quarantined

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AUDIT_DDL = (
    "batch_id LONG, messages LONG, accepted LONG, dupes LONG, quarantined LONG, unrouted LONG, seconds DOUBLE, accepted_per_sec DOUBLE"
)


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application with its own streaming settings.

    The number of state partitions is fixed at the first start of a query, and
    adaptive execution does not apply to it, so it is chosen here.
    """
    session = spark.newSession()
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Counting the rows of the state costs one more lookup for every id, and a batch
    # without messages goes through the whole state to find nothing but expired ids,
    # which the next batch removes as well.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    # Room for the index of a partition's files, which grows with its ids; 8 MB hold that of a few million only.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB", "64")
    # Longer functions are run, but not compiled to machine code; Spark has shorter ones for what they do.
    session.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    session.conf.set(*bloom.CO_PARTITION)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def classified(messages: DataFrame) -> DataFrame:
    """Flight columns, position and raw text of every message, with the reason to set it aside (null: none)."""
    rows = decode_json(messages.withColumn("raw", F.col("value").cast("string")))
    unrouted = F.col("origin").isNull() | F.col("destination").isNull()
    reason = F.when(is_quarantined(), F.lit("unreadable")).when(unrouted, F.lit("unrouted"))
    return rows.withColumn("reason", reason).drop(CORRUPT)


def deduplicated(rows: DataFrame, horizon: str | None) -> DataFrame:
    """One row per id. `horizon` bounds the state: a copy that comes later than that
    after the first delivery passes. None keeps every id forever."""
    if horizon is None:
        return rows.dropDuplicates(["flight_id"])
    clocked = rows.withColumn("seen_at", F.current_timestamp()).withWatermark("seen_at", horizon)
    return clocked.dropDuplicatesWithinWatermark(["flight_id"]).drop("seen_at")


def set_aside_only(*names: str) -> list[Column]:
    """Columns that are read of messages set aside only, empty for all others."""
    return [F.when(F.col("reason").isNotNull(), F.col(name)).alias(name) for name in names]


def write_quarantine(batch: DataFrame, quarantine: str, batch_id: int) -> None:
    aside = batch.filter("reason is not null").select("position", "raw", "reason")
    aside.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")


def write_audit(arrived: DataFrame, accepted: DataFrame, audit: str, batch_id: int, started: float) -> None:
    """One row of the audit, under the batch's number: messages = accepted + dupes + quarantined + unrouted."""
    counted = arrived.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count(F.when(F.col("reason") == "unreadable", 1)).alias("quarantined"),
        F.count(F.when(F.col("reason") == "unrouted", 1)).alias("unrouted"),
    ).first()
    fresh = accepted.count()
    seconds = time.monotonic() - started
    dupes = counted.messages - counted.quarantined - counted.unrouted - fresh
    row = (batch_id, counted.messages, fresh, dupes, counted.quarantined, counted.unrouted, seconds, fresh / seconds)
    written = arrived.sparkSession.createDataFrame([row], AUDIT_DDL).drop("batch_id")
    written.coalesce(1).write.mode("overwrite").parquet(f"{audit}/batch_id={batch_id}")


def start_ingest(
    messages: DataFrame, output: str, quarantine: str, audit: str, checkpoint: str, horizon: str | None = "7 days",
    every: str | None = None,
) -> StreamingQuery:
    """Start the stream. Without `every` it works through the backlog and stops;
    with it, a new batch starts at that interval until the query is stopped."""
    rows = classified(messages)
    # Two branches of one query: every message as it arrived, without its content and
    # place unless it is set aside, and the rows that deduplication lets through.
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in rows.select(*FLIGHT_COLUMNS).dtypes]
    arrived = rows.select(F.lit(True).alias("arrived"), "reason", *set_aside_only("position", "raw"), *nothing)
    fresh = deduplicated(rows.filter("reason is null").select(*FLIGHT_COLUMNS), horizon).select(
        F.lit(False).alias("arrived"), *[F.lit(None).cast("string").alias(name) for name in ("reason", "position", "raw")], *FLIGHT_COLUMNS
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        # A repeated batch replaces its own folders, so a crash half way is harmless.
        started = time.monotonic()
        batch.persist()
        try:
            accepted, messages_seen = batch.filter("not arrived"), batch.filter("arrived")
            accepted.select(*FLIGHT_COLUMNS).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
            write_quarantine(messages_seen, quarantine, batch_id)
            write_audit(messages_seen, accepted, audit, batch_id, started)
        finally:
            batch.unpersist()

    writer = arrived.unionByName(fresh).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch, of all runs of the query."""
    return spark.read.schema(AUDIT_DDL).parquet(path).filter("messages > 0")


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
