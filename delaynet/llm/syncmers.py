"""Document fingerprints from closed syncmers.

A k-mer is a closed syncmer if the smallest of its s-mers, by hash, is the first or
the last one. Whether a k-mer is chosen depends on its own characters alone, so the
same passage yields the same anchors wherever it stands, and every window of
k - s + 1 positions holds at least one.

A fingerprint samples the anchors: each falls into one of SLOTS classes by its hash,
and a class keeps its smallest hash, how often it occurs and the first place. Two
fingerprints are compared class by class; anchors that agree must also come in the
same order in both texts, so chance matches out of place do not count. Short texts
have anchors of a second, finer scale as well, in classes of their own, which are
compared if both texts have them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.llm.common import STEP_CHARS, map_batches

K, S = 16, 6
FINE_K, FINE_S = 6, 3
SHORT = 200  # characters below which the fine scale is added
SLOTS = 64
MOST_RANGES = 20_000  # of ids, each read by one task in order
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: xor-shifts and odd multipliers."""
    x = x.copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _grams(points: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` code points."""
    total = np.zeros(len(points) - size + 1, dtype=np.uint64)
    for at in range(size):
        total = total * _MULTIPLIER + points[at : at + len(total)]
    return _mixed(total)


def closed_syncmers(points: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every k-mer whose smallest s-mer is its first or last; a shorter text is its own only one."""
    if len(points) < k:
        return (_grams(points, len(points)), np.zeros(1, np.int64)) if len(points) else (points, np.zeros(0, np.int64))
    inner = _grams(points, s)
    width = k - s + 1
    least, span = inner, 1  # sliding minimum by doubling
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    last = inner[width - 1 :]
    places = np.flatnonzero(np.minimum(inner[: len(last)], last) == least)
    total = np.zeros(len(places), dtype=np.uint64)
    for at in range(k):
        total = total * _MULTIPLIER + points[places + at]
    return _mixed(total), places


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of all anchors of a text at one scale; an empty text has none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return closed_syncmers(points, k, s)


Sketch = tuple[np.ndarray, np.ndarray, np.ndarray]  # hash, first place and occurrences by class


def sketch(hashes: np.ndarray, places: np.ndarray, slots: int = SLOTS) -> Sketch:
    """What each class keeps; empty classes hold the largest hash and occur 0 times."""
    kept, where = np.full(slots, _EMPTY), np.full(slots, 2**32 - 1, dtype=np.int64)
    group = (hashes % np.uint64(slots)).astype(np.int64)
    np.minimum.at(kept, group, hashes)
    chosen = hashes == kept[group]
    np.minimum.at(where, group[chosen], places[chosen])
    return kept, where, np.bincount(group[chosen], minlength=slots)


def likeness(one: Sketch, other: Sketch) -> float:
    """Occurrences that agree, in the same order in both texts, among those of the fuller side of each class.

    Each scale that both fingerprints have counts, with an order of its own. Two
    empty fingerprints are alike (1), an empty one is unlike any other (0).
    """
    agree, either = 0.0, 0
    for at in range(0, min(len(one[0]), len(other[0])), SLOTS):
        (hashes, places, often), (hashes2, places2, often2) = ([part[at : at + SLOTS] for part in side] for side in (one, other))
        either += int(np.maximum(often, often2).sum())
        same = (hashes == hashes2) & (often > 0)
        second = places2[same][np.lexsort((places2[same], places[same]))]
        rising: list[int] = []  # the longest rising run of places
        for place in second.tolist():
            before = bisect_left(rising, place)
            rising[before : before + 1] = [place]
        if rising:
            agree += float(np.minimum(often, often2).sum(where=same) * len(rising) / len(second))
    return agree / either if either else 1.0


def written(one: Sketch) -> str:
    """The fingerprint as text: for each class, 8 hexadecimal digits each of its hash, place and occurrences."""
    hashes, places, often = one
    rows = np.stack([hashes & np.uint64(0xFFFFFFFF), places.astype(np.uint64), often.astype(np.uint64)], axis=1)
    return rows.astype(">u4").tobytes().hex()


def fingerprint(text: str | None) -> Sketch:
    """SLOTS classes of the coarse scale, and in a short text as many of the fine one behind them."""
    text = text or ""
    coarse = sketch(*anchors(text))
    if len(text) >= SHORT:
        return coarse
    fine = sketch(*anchors(text, FINE_K, FINE_S))
    return tuple(np.concatenate(parts) for parts in zip(coarse, fine))


# Texts in order of their id, each with the one after it


def _buckets(docs: DataFrame, doc_id: str, size: int) -> list[int]:
    """Ids that cut the rows into ranges of about `size` rows, or more if that would make over MOST_RANGES."""
    rows = docs.count()
    parts = max(1, min(MOST_RANGES, -(-rows // size)))
    if parts == 1:
        return []
    shares = [i / parts for i in range(1, parts)]
    cuts = docs.select(F.col(doc_id).cast("bigint").alias("id")).approxQuantile("id", shares, 0.1 / parts)
    return sorted({int(cut) for cut in cuts})


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_range: int = 2000) -> DataFrame:
    """Rows `range, ahead, doc_id, text`, sorted in their ranges: by id, ties by text, rows without an id first.

    Each range ends with a copy of the row that follows it (`ahead`), the last one
    with the first row of all, so a task that reads a range sees every neighbour.
    """
    cuts = _buckets(docs, doc_id, rows_per_range)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(_place(cuts)).cast("int"))

    starts = rows.groupBy("range").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("id")).collect()  # one row per range
    starts = sorted((row.range, row.id) for row in starts)
    if not starts:
        return rows.withColumn("ahead", F.lit(False)).select("range", "ahead", "doc_id", "text")
    before = {number: starts[at - 1][0] for at, (number, _) in enumerate(starts)}
    names = rows.sparkSession.createDataFrame([(n, i, before[n]) for n, i in starts], "range int, id bigint, target int")
    heads = rows.join(F.broadcast(names), (rows["range"] == names["range"]) & (F.coalesce("doc_id", F.lit(-(2**63))) == F.col("id")))
    heads = heads.groupBy("target", "doc_id").agg(F.min("text").alias("text"))
    ahead = heads.select(F.col("target").alias("range"), F.lit(True).alias("ahead"), "doc_id", "text")
    both = rows.select("range", F.lit(False).alias("ahead"), "doc_id", "text").unionByName(ahead)
    order = ["range", "ahead", F.col("doc_id").asc_nulls_first(), "text"]
    return both.repartition(len(starts), "range").sortWithinPartitions(*order)


def _place(cuts: list[int]) -> Column:
    """How many cuts are at or below the id, by halving steps over one constant array."""
    if not cuts:
        return F.lit(0)
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    steps = F.lit([1 << bit for bit in range(len(cuts).bit_length() - 1, -1, -1)])
    reached = lambda at: F.coalesce(F.try_element_at(bounds, at) <= F.col("doc_id"), F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(reached(at + step), at + step).otherwise(at))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many first characters of the next, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_range: int = 2000) -> DataFrame:
    """Each row's fingerprint against that of its edited text and of the next row's.

    The next row is that of the next id (ties: next text); after the last comes the
    first, which may be the row itself. Null texts count as empty. Other columns
    are not read.
    """
    names = [column.split()[0] for column in _COMPARED.split(", ")]

    def run(batches):
        held = None  # the row that waits for the one after it: range, id, text, fingerprint
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for number, ahead, key, content in zip(*[batch.column(n).to_pylist() for n in ("range", "ahead", "doc_id", "text")]):
                own = fingerprint(content)
                if held is not None and held[0] == number:
                    _, last_key, last, mark = held
                    changed = edited(last, content)
                    change = fingerprint(changed)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((last_key, len(last), digest, written(mark), written(change), likeness(mark, change), likeness(mark, own)))
                    size += len(last)
                held = None if ahead else (number, key, content, own)
                if size > STEP_CHARS:
                    yield pa.RecordBatch.from_arrays(_columns(out), names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays(_columns(out), names=names)

    rows = in_order(docs, doc_id, text, rows_per_range)
    return map_batches(rows, run, _COMPARED)


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
