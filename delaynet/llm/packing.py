"""Best-fit packing of token pieces by exact complements of their lengths.

A piece matters to the packing only by its length, and lengths are at most the
capacity. So Spark cuts and counts the pieces, the driver plans over the counts
(a table of `capacity` numbers, whatever the size of the corpus), and Spark deals
the pieces of each length out to the places that the plan holds for that length.

The plan fills gaps exactly where it can: it keeps an index of the lengths still
available (single), of their pair sums, and searches triples as a length plus an
indexed pair. A combination is used as often as its counts allow at once. What no
exact combination closes is packed best-fit: the longest piece that still fits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaynet.llm.common import map_batches, map_rows, texts_of
from delaynet.llm.vocabularies import byte_bpe
from delaynet.session import materialize

CAPACITY = 2048
END_ID = 0

PIECES = "doc_id bigint, piece int, start bigint, length int, ids binary"


def pieces(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    pattern: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Token pieces of at most `capacity` ids per document, with the ids as little-endian 32-bit bytes.

    Every text ends with `end_id`; a null or empty text is that id alone. Only
    documents above the capacity are cut, their first piece being the shorter
    one. Rows that repeat a doc_id, or have none, are documents of their own.
    """

    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary())]
    )
    step = 1000  # texts whose ids are held at once, next to the batch itself

    def run(batches):
        encode = byte_bpe(tokenizer, ranks, pattern).encode
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                out: list[list] = [[], [], [], [], []]
                for key, content in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                    ids = encode(content or "") + end
                    n = len(ids) // 4
                    cut = (n - 1) % capacity + 1
                    bounds = [0, *range(cut, n + 1, capacity)]
                    for at, (low, high) in enumerate(zip(bounds, bounds[1:])):
                        for column, value in zip(out, (key, at, low, high - low, ids[4 * low : 4 * high])):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, schema)], schema=schema)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, run, PIECES)


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go, by their number among that length.

    Interval i holds the pieces `length[i]`, numbers from `rank[i]` to the next
    interval of that length: `times[i]` in each sequence from `sequence[i]` on,
    one after the other from `offset[i]`.
    """

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray

    _SHIFT = 48  # ranks stay far below 2**48, lengths below 2**15

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (self.length << self._SHIFT) + self.rank
        at = np.searchsorted(keys, (length << self._SHIFT) + rank, side="right") - 1
        number = rank - self.rank[at]
        return self.sequence[at] + number // self.times[at], self.offset[at] + number % self.times[at] * length


class _Stock:
    """Counts by length, with the lengths and pair sums that they still allow."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.left[0] = 0
        size = len(self.left)
        self.single = self.left > 0
        once = self.single.astype(np.int64)
        sums = np.convolve(once, once)[:size]
        self.pairs = np.zeros(size, dtype=np.int64)  # ordered pairs of available lengths by their sum
        self.pairs[: len(sums)] = sums

    def most(self, combination: list[int]) -> int:
        """How often the combination can be taken."""
        return min(int(self.left[x]) // combination.count(x) for x in set(combination))

    def take(self, combination: list[tuple[int, int]], often: int) -> None:
        for length, times in combination:
            self.left[length] -= times * often
            if self.left[length] == 0:
                self.single[length] = False
                size = len(self.left)
                self.pairs[length:] -= 2 * self.single[: size - length].astype(np.int64)
                if 2 * length < size:
                    self.pairs[2 * length] -= 1

    def exact(self, first: int, gap: int) -> list[int] | None:
        """One, two or three lengths that fill the gap beside `first`, the longest ones first."""
        if gap < len(self.left) and self.single[gap] and self.most([first, gap]):
            return [gap]
        if (pair := self._pair([first], gap)) is not None:
            return pair
        top = min(gap - 2, len(self.left) - 1)
        if top < 1:
            return None
        lengths = np.arange(1, top + 1)
        for third in lengths[self.single[1 : top + 1] & (self.pairs[gap - lengths] > 0)][::-1]:
            if (pair := self._pair([first, int(third)], gap - int(third))) is not None:
                return [int(third), *pair]
        return None

    def _pair(self, beside: list[int], gap: int) -> list[int] | None:
        if gap < 2 or gap >= len(self.pairs) or not self.pairs[gap]:
            return None
        lower = np.arange(1, gap // 2 + 1)
        for a in lower[self.single[lower] & self.single[gap - lower]]:
            pair = [gap - int(a), int(a)]
            if self.most([*beside, *pair]):
                return pair
        return None


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """The packing of `counts[length]` pieces of each length from 1 to `capacity`."""
    stock = _Stock(np.asarray(counts)[: capacity + 1])
    rows: list[tuple[int, int, int, int, int]] = []
    used = np.zeros(capacity + 1, dtype=np.int64)
    sequences = 0

    def commit(combination: list[tuple[int, int]], often: int) -> None:
        nonlocal sequences
        offset = 0
        for length, times in combination:
            rows.append((length, int(used[length]), sequences, times, offset))
            used[length] += times * often
            offset += times * length
        stock.take(combination, often)
        sequences += often

    def counted(combination: list[int]) -> list[tuple[int, int]]:
        return [(x, combination.count(x)) for x in sorted(set(combination), reverse=True)]

    for length in range(capacity, 0, -1):
        while stock.left[length]:
            if length == capacity:
                commit([(length, 1)], int(stock.left[length]))
                continue
            others = stock.exact(length, capacity - length)
            if others is None:
                break
            commit(counted([length, *others]), stock.most([length, *others]))
    for length in range(capacity, 0, -1):  # what no exact combination closed
        while stock.left[length]:
            combination, gap, often = [(length, 1)], capacity - length, int(stock.left[length])
            kept = stock.left.copy()
            kept[length] -= 1
            while gap and len(fits := np.flatnonzero(kept[: gap + 1])):
                best = int(fits[-1])
                times = min(gap // best, int(kept[best]))
                if best == combination[0][0]:
                    combination[0] = (best, combination[0][1] + times)
                else:
                    combination.append((best, times))
                kept[best] -= times
                gap -= times * best
            often = min(int(stock.left[x]) // times for x, times in combination)
            commit(combination, often)
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return Plan(*table.T.copy())


def pack(
    cut: DataFrame, capacity: int = CAPACITY, carry: dict[str, Column] | None = None
) -> DataFrame:
    """Place every piece: its columns, `sequence_id`, and `offset` in that sequence.

    `carry` gives expressions over the pieces to keep instead of their ids. The
    counts that reach the driver are at most `capacity` numbers. Each task
    numbers its pieces per length; adding the counts of the tasks before it gives
    a number among all of that length, without bringing a length's rows together.
    An empty table has no pieces.
    """
    spark = cut.sparkSession
    carry = {"ids": F.col("ids")} if carry is None else carry
    through = ["doc_id", "piece", "start", *carry]
    kept = cut.select("doc_id", "piece", "start", "length", *[value.alias(name) for name, value in carry.items()])

    def number(batches):
        seen = np.zeros(capacity + 1, dtype=np.int64)
        task = TaskContext.get().partitionId()
        for batch in batches:
            length = batch.column("length").to_numpy()
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, int)
            sizes = np.diff(np.r_[starts, len(ordered)])
            within = np.empty(len(length), dtype=np.int64)
            within[order] = np.arange(len(length)) - np.repeat(starts, sizes) + seen[ordered]
            seen[ordered[starts]] += sizes
            fields = [*batch.columns, pa.array(np.full(len(length), task)), pa.array(within)]
            yield pa.RecordBatch.from_arrays(fields, names=[*batch.schema.names, "task", "within"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", task bigint, within bigint"
    numbered = materialize(map_batches(kept, number, schema), "pieces")
    by_task = numbered.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))

    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in numbered.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `capacity` rows
        counts[row.length] = row.n
    planned = spark.sparkContext.broadcast(plan(counts, capacity))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length = batch.column("length").to_numpy().astype(np.int64)
        rank = batch.column("begin").to_numpy() + batch.column("within").to_numpy()
        sequence, offset = planned.value.place(length, rank)
        fields = [*[batch.column(name) for name in through], pa.array(length), pa.array(sequence), pa.array(offset)]
        return pa.RecordBatch.from_arrays(fields, names=[*through, "length", "sequence_id", "offset"])

    kinds = dict(kept.dtypes)
    placed = ", ".join(f"`{name}` {kinds[name]}" for name in through)
    joined = numbered.join(begins, ["task", "length"])
    return map_rows(joined, place, placed + ", length bigint, sequence_id bigint, offset bigint")
