"""Importance resampling of a corpus towards the distribution of a target.

Words come from an untrained `tokenizers` Split over text whose A-Z are lower-cased.
The features of a text are all runs of 1 to GRAMS consecutive words joined by a space,
repeats included: windows over the words' offset pairs. A feature's bucket is the CRC-32
of its UTF-8 bytes modulo BUCKETS, which follows from the checksums and lengths of the
words in the window. The gain of
a bucket is the logarithm of how much more often the target than the corpus fills it,
smoothed by one; a text's weight is the sum of its features' gains, and weights plus
Gumbel noise keyed by the id, sorted, are a draw without replacement.

Split costs far more than looking a word up, so a worker remembers the
checksums of the words of the stretches between spaces that it met, and hands the other
stretches of a text to Split at once.

A text is split once. The buckets of its features are written, two bytes each, and read
again for the counts of the whole corpus and for the weights.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from delaynet.llm.common import map_batches
from delaynet.session import materialize

BUCKETS = 10_000  # at most 65536, as they are written in two bytes
GRAMS = 3
LEAST_WORDS = 20  # of a text that can be drawn
SHARE = 5  # percent of the texts that can be drawn
SEED = 42
PIECE_CHARS = 1_000_000  # of a text that are split at a time
CACHE_ENTRIES = 800_000  # stretches between spaces, and words of them, that a worker remembers

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_PLACE_BITS = 33  # of monotonically_increasing_id: the place within the task's partition


def lowered(text: str) -> str:
    """The text with A-Z lower-cased and every other character as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in order, cut between words only, so that a very long one is never split as a whole."""
    at = 0
    while len(text) - at > size:
        border = _BETWEEN.search(text, at + size)
        if not border:
            break
        yield text[at : border.start()]
        at = border.start()
    yield text[at:]


def _zeros_table(most: int) -> np.ndarray:
    """[n, k, v]: what the byte v at place k of a CRC-32 becomes when n zero bytes follow."""
    bytewise = np.array([zlib.crc32(bytes([v]), 0xFFFFFFFF) ^ 0xFFFFFFFF for v in range(256)], dtype=np.uint32)
    table = np.zeros((most + 1, 4, 256), dtype=np.uint32)
    table[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(most):
        table[n + 1] = (table[n] >> 8) ^ bytewise[table[n] & 0xFF]
    return table


_SHORT = 63  # bytes of words that go through the table
_ZEROS = _zeros_table(_SHORT)


def joined(sums: np.ndarray, more: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of texts one behind the other, from the sums of both and the length of the second."""
    short = np.minimum(lengths, _SHORT)
    moved = _ZEROS[short, 0, sums & 0xFF] ^ _ZEROS[short, 1, (sums >> 8) & 0xFF] ^ _ZEROS[short, 2, (sums >> 16) & 0xFF] ^ _ZEROS[short, 3, sums >> 24]
    for at in np.flatnonzero(lengths > _SHORT):
        zeros = bytes(int(lengths[at]))
        moved[at] = zlib.crc32(zeros, int(sums[at])) ^ zlib.crc32(zeros)
    return moved ^ more


class Windows:
    """Buckets of the features of single texts."""

    def __init__(self, grams: int = GRAMS, buckets: int = BUCKETS):
        self.grams, self.buckets = grams, buckets
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[str, int] = {}  # place of a stretch's first word in the arrays below, and how many there are
        self.sums, self.spaced, self.sizes = array("I"), array("I"), array("q")  # of the word, of a space and the word, and its bytes

    def words(self, piece: str) -> list[np.ndarray]:
        """Checksums of the words of lower-cased text, with and without a space before, and lengths with it.

        A space is in no word, so each stretch between spaces has its own.
        """
        stretches = piece.split(" ")
        new = [stretch for stretch in dict.fromkeys(stretches) if stretch not in self.seen]
        self.seen.update(self._split(new))
        codes = np.fromiter(map(self.seen.__getitem__, stretches), np.int64, len(stretches))
        counts = codes & _COUNT
        ends = np.cumsum(counts)
        places = np.repeat((codes >> _COUNT_BITS) + counts - ends, counts) + np.arange(ends[-1])
        found = [np.frombuffer(column, kind)[places] if len(column) else np.zeros(0, kind) for column, kind in ((self.sums, np.uint32), (self.spaced, np.uint32), (self.sizes, np.int64))]
        if len(self.seen) + len(self.sums) > CACHE_ENTRIES:
            self._forget()
        return found

    def _split(self, stretches: list[str]) -> Iterator[tuple[str, int]]:
        """The words of stretches, split as one text and told apart by their offsets."""
        pairs = iter(self.split.pre_tokenize_str(" ".join(stretches)) if stretches else ())
        word, (start, _) = next(pairs, _NO_WORD)
        end = -1
        for stretch in stretches:
            end += len(stretch) + 1
            first = len(self.sums)
            while start < end:
                spaced = b" " + word.encode("utf-8", "surrogatepass")
                self.sums.append(zlib.crc32(spaced[1:]))
                self.spaced.append(zlib.crc32(spaced))
                self.sizes.append(len(spaced))
                word, (start, _) = next(pairs, _NO_WORD)
            yield stretch, first << _COUNT_BITS | len(self.sums) - first

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every feature, in no stated order."""
        count, found, carried = 0, [np.zeros(0, "<u2")], None
        for piece in _pieces(lowered(text or "")):
            words = self.words(piece)
            old = len(carried[0]) if carried else 0
            if old:
                words = [np.concatenate(two) for two in zip(carried, words)]
            sums, spaced, sizes = words
            count += len(sums) - old
            carried = [column[max(0, len(sums) - self.grams + 1) :] for column in words]
            for more in range(self.grams):  # windows whose last word is new
                if more:
                    sums = joined(sums[:-1], spaced[more:], sizes[more:])
                found.append((sums[max(0, old - more) :] % self.buckets).astype("<u2"))
        return count, np.concatenate(found)


_NO_WORD = ("", (1 << 62, 0))
_COUNT_BITS = 24  # of the words in a stretch, which is at most a piece, or one word and what is up to it
_COUNT = (1 << _COUNT_BITS) - 1


def featured(rows: DataFrame, key: str | None = None, text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """`id, n_words, n_features, buckets` of every row's whole text; a null text has no words.

    Texts of any length are split in pieces cut between words. Rows that repeat a key
    each give a row. Other columns are not read.
    """

    def run(batches):
        windows = Windows(grams, buckets)
        for batch in batches:
            found = [windows.of(content.as_py()) for content in batch.column("text")]
            columns = [
                batch.column("id"), pa.array([n for n, _ in found], pa.int64()), pa.array([len(b) for _, b in found], pa.int64()),
                pa.array([b.tobytes() for _, b in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_features", "buckets"])

    id_ = F.col(key) if key else F.lit(None)
    return map_batches(rows.select(id_.cast("bigint").alias("id"), F.col(text).alias("text")), run, "id bigint, n_words bigint, n_features bigint, buckets binary")


def histogram(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket is filled, over all rows. A task sends one row for each bucket that it met."""

    def run(batches):
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for content in batch.column("buckets"):
                counts += np.bincount(np.frombuffer(content.as_buffer(), dtype="<u2"), minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(counts[met])], names=["bucket", "n"])

    rows = map_batches(features.select("buckets"), run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for row in rows:
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target to source for each bucket, rounded down."""
    s, t, size = source.astype(float), target.astype(float), float(len(source))
    ratios = ((t + 1) * (source.sum() + size)) / ((s + 1) * (target.sum() + size))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], dtype=np.int64)


def weighed(features: DataFrame, by_bucket: np.ndarray) -> DataFrame:
    """`id, n_words, n_features, weight`: the sum of the gains of a text's features, 0 if it has none."""
    shared = features.sparkSession.sparkContext.broadcast(by_bucket)

    def run(batches):
        for batch in batches:
            weights = [int(shared.value[np.frombuffer(content.as_buffer(), dtype="<u2")].sum()) for content in batch.column("buckets")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())], names=["id", "n_words", "n_features", "weight"])

    return map_batches(features.select("id", "n_words", "n_features", "buckets"), run, "id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel value keyed by seed and id, rounded down. A null id counts as an empty one."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.ln(-F.ln(uniform))).cast("bigint")


def drawn(weights: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """`id, n_features, weight, score, rank`: ranks from 1 for the drawn rows, null for others.

    Of the n rows with `least_words` words, the floor(share * n / 100) with the highest
    scores are drawn; ties go to smaller ids, then to fewer features, and rows equal in
    all of that are dealt out by their place. The order is over all rows: a range
    partitioning on narrow rows, numbered within each partition and shifted by the
    counts of the partitions before it.
    """
    spark = weights.sparkSession
    rows = weights.select("*", (F.col("weight") + noise(F.col("id"), seed)).alias("score"), (F.col("n_words") >= least_words).alias("able"))
    order = [F.col("able").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("salt")]
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    placed = materialize(salted.sort(*order).withColumn("place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("able").alias("able")).orderBy("part").collect()
    most = share * sum(row.able for row in sizes) // 100
    before, shifts = 0, []
    for row in sizes:  # one for each partition of the sort
        shifts.append((row.part, before))
        before += row.n
    offsets = F.broadcast(spark.createDataFrame(shifts, "part bigint, before bigint"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1) + 1
    ranked = placed.withColumn("part", part.cast("bigint")).join(offsets, "part", "left").withColumn("rank", rank)
    return ranked.select("id", "n_features", "weight", "score", F.when(F.col("able") & (F.col("rank") <= most), F.col("rank")).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", grams: int = GRAMS,
    buckets: int = BUCKETS, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """`doc_id, n_features, weight, score, rank` of every document, drawn towards the texts of `target`.

    Null and empty texts have no features and weight 0 and are never drawn, rows that
    repeat an id or a text are documents of their own, texts of any length count as a
    whole, and no documents give no rows. An empty target leaves only the smoothing.
    Other columns are not read.
    """
    features = materialize(featured(docs, doc_id, text, grams, buckets), "features")
    wanted = histogram(featured(target, None, target_text, grams, buckets), buckets)
    weights = materialize(weighed(features, gains(histogram(features, buckets), wanted)), "weights")
    return drawn(weights, share, least_words, seed).withColumnRenamed("id", "doc_id")
