"""Records as broker messages: encoding, decoding and the stream source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from delaynet.schema import FLIGHT_SCHEMA, MESSAGE_DDL

CORRUPT = "_corrupt"


def encode_json(rows: DataFrame, *columns: str) -> Column:
    return F.to_json(F.struct(*(columns or rows.columns)))


def keyed_messages(rows: DataFrame, id_column: str = "flight_id", prefix: str = "flight") -> DataFrame:
    """Messages with a stable key, ready for `write.format("kafka")`."""
    return rows.select(
        F.concat(F.lit(f"{prefix}-"), F.col(id_column)).alias("key"),
        encode_json(rows).alias("value"),
    )


def decode_json(messages: DataFrame, schema: StructType = FLIGHT_SCHEMA, value: str = "value") -> DataFrame:
    """Flattened JSON values, other message columns kept; unreadable text lands in `_corrupt`.

    The values come out of a generator, below which no filter is pushed: a filter on
    decoded columns would otherwise take the whole decoding along and do it twice.
    """
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    kept = [name for name in messages.columns if name != value]
    return messages.select(*kept, F.inline(F.array(parsed)))


def is_quarantined(id_column: str = "flight_id") -> Column:
    """True for values that are not JSON objects of the schema, or lack the id."""
    return F.col(CORRUPT).isNotNull() | F.col(id_column).isNull()


def kafka_options(servers: str, topic: str, max_offsets: int = 50_000, timeout_ms: int = 300_000) -> dict[str, str]:
    """Options of the Kafka source: from the earliest offset, at most `max_offsets` messages a batch."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(max_offsets),
        "failOnDataLoss": "false",
        "kafka.request.timeout.ms": str(timeout_ms),
        "kafka.session.timeout.ms": str(timeout_ms),
    }


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int = 50_000) -> DataFrame:
    """Message stream from Kafka; needs the connector package on the class path."""
    source = spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_offsets)).load()
    position = F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return source.select("value", position.alias("position"))


def file_stream(spark: SparkSession, path: str, max_files: int = 100, max_age: str = "36500d") -> DataFrame:
    """The same message layout from Parquet files of keys and values.

    Files count as new by their path alone: `max_age`, by which Spark would
    otherwise pass over files a week older than the newest, is set far out.
    """
    return (
        spark.readStream.schema(MESSAGE_DDL)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", max_age)
        .parquet(path)
        .select("value", F.concat_ws(":", "_metadata.file_path", F.col("_metadata.row_index").cast("string")).alias("position"))
    )
