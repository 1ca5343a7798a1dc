"""WARC archives with revisit records in place of repeated payloads.

Only headers are shuffled by payload digest: the first original of each digest is
a partial minimum, and its identity is joined back to the headers of the others.
Payloads move once, by record, to the tasks that write the archives. Spark's own
text sink writes them, compressed, to any file system that Spark reaches; reading
parses one archive at a time, record by record.
"""

from __future__ import annotations

import gzip
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaynet.llm.common import map_batches
from delaynet.session import materialize

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
RECORD_END = "\r\n\r\n"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

DATE = "2024-01-01T00:00:00Z"  # of every record, so that archives can be repeated
LEAST_BYTES = 0  # payloads below are written in full each time


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of the payload in base 32: five hex digits at a time make four characters."""
    digits, characters = F.sha1(payload), []
    for start in range(0, 40, 5):
        number = F.conv(F.substring(digits, start + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            characters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*characters)


def headers(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """`page_id, url, payload_bytes, payload_digest`; a null payload counts as empty."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    return pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )


def originals(heads: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """`payload_digest, original, original_url` of each payload of at least `least_bytes` that occurs more than once.

    The original is the row with the smallest page_id, of several such rows that with the smallest url.
    """
    large = heads.filter(F.col("payload_bytes") >= least_bytes)
    known = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    first = large.groupBy("payload_digest").agg(F.min(known).alias("first"), F.count(F.lit(1)).alias("n"))
    return first.filter("n > 1 and first is not null").select(
        "payload_digest", F.col("first.page_id").alias("original"), F.col("first.url").alias("original_url")
    )


def resolve(heads: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The headers of revisits, with `original` and `original_url`.

    Rows that repeat the original's page_id are responses like it. Rows without
    an id revisit an original that has one, and are responses otherwise. Originals
    are written first, so that the join with a digest that very many headers share
    is either a broadcast or split by adaptive execution.
    """
    first = materialize(originals(heads, least_bytes), "originals")
    return heads.join(first, "payload_digest").filter(~F.col("page_id").eqNullSafe(F.col("original")))


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(pages: DataFrame, revisits: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One `value` per page: its whole record without the blank lines that end it."""
    known = revisits.select(
        F.col("page_id").alias("__id"), F.col("payload_digest").alias("__digest"), "original", "original_url"
    ).distinct()
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload")
    ).withColumns({"bytes": F.octet_length("payload"), "digest": base32_sha1(F.encode("payload", "UTF-8"))})
    # The id alone decides where a row goes, so copies of one payload spread over all tasks.
    same = F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))
    rows = rows.join(known, same, "left")
    revisit = F.col("original").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit("\r\n\r\n"),
    )
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    clean = lambda text: F.regexp_replace(text, r"[\r\n]+", " ")  # noqa: E731  a header is one line
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", clean(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(IDENTICAL_PAYLOAD)),
                line("WARC-Refers-To", record_id(F.col("original"))),
                line("WARC-Refers-To-Target-URI", clean(F.col("original_url"))),
                line("WARC-Refers-To-Date", F.lit(DATE)),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("value"))


def write_archives(values: DataFrame, path: str) -> None:
    """Compressed archives, one per task, that end every record with two blank lines."""
    values.write.option("compression", "gzip").option("lineSep", RECORD_END).text(path)


def parsed(stream: io.BufferedIOBase):
    """Headers and block of each record of an archive, in order."""
    while line := stream.readline():
        if line.strip() == b"":
            continue
        if line.strip().decode() != VERSION:
            raise ValueError(f"not the start of a WARC record: {line[:80]!r}")
        found = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            found[name.strip()] = value.strip()
        yield found, stream.read(int(found["Content-Length"]))


_READ = "record_type string, record_id string, refers_to string, target_uri string, payload_digest string, payload_bytes bigint, payload binary"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under `path`.

    `payload_bytes` is that of the full payload, for revisits as well: their block
    keeps the HTTP headers. `payload` is null for revisits, or if not asked for.
    """
    names = [column.split()[0] for column in _READ.split(", ")]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for found, block in parsed(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = next(int(h.partition(b":")[2]) for h in http.split(b"\r\n") if h.lower().startswith(b"content-length:"))
                    kind = found["WARC-Type"]
                    if kind == "response" and len(payload) != size:
                        raise ValueError(f"record {found['WARC-Record-ID']} is cut off")
                    rows.append((
                        kind, found["WARC-Record-ID"], found.get("WARC-Refers-To"), found["WARC-Target-URI"],
                        found["WARC-Payload-Digest"].removeprefix("sha1:"), size,
                        payload if payloads and kind == "response" else None,
                    ))
                    held += len(payload) if payloads else 100
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return map_batches(files, run, _READ)


def page_of(record: Column) -> Column:
    return F.regexp_extract(record, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write all pages to archives under `path`; the records as read back from there.

    Payloads are read and hashed once for the headers, which are written, and once
    more as records. The revisits are written as well: Spark then knows their size,
    and moves the payloads only where there are too many revisits to send to every task.

    A null payload or url counts as empty, and an empty payload is one like any other.
    Rows without an id never are originals. Repeated rows of the original are
    responses, of other pages revisits. Payloads of any length stay whole, and the
    other columns are not read. No pages make no records.
    """
    heads = materialize(headers(pages), "headers")
    revisits = materialize(resolve(heads, least_bytes), "revisits")
    write_archives(records(pages, revisits), path)
    return read_archives(pages.sparkSession, path, payloads=False)
