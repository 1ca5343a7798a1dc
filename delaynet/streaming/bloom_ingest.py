"""Approximate cross-batch deduplication with a persisted Bloom filter.

The opt-in alternative to exact state: memory follows the filter's bits, at the
price of dropping a small, known share of new rows. The filter grows by
generations: each holds twice the items of the one before it at half its rate of
false positives, so the shares of all generations add up to less than the wanted
rate however long the stream runs.

The filter is kept as a log. Each batch is tested against the filter as of the
batch's start, and writes an entry with the bits of its own accepted keys, so what it
writes follows the batch and not the filter. Every `COMPACT_EVERY` batches the entries
are folded into a base. Keys of a large batch have a block each, in which a base has
room for twenty: a batch with which as many keys came since the last base as that has
blocks writes a base at once, in place of its entry. So no batch reads more than about
twice the filter, and bases take no more writing than entries would. Entries and bases
that the last base makes needless are dropped at the start of the batch after it. A
repeated batch replaces its own entry and reads only those before it, so it gives the
same result. An entry or base that is missing or unfinished stops the stream: without
it, old ids would pass as new. A log is read with the `Growth` that it was written with.

A small filter is broadcast, generation by generation. Of a larger one every task holds
its lanes (`bloom.in_none`), so rows move once whatever the number of generations.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delaynet.operators import bloom
from delaynet.schema import FLIGHT_COLUMNS
from delaynet.streaming.ingest import classified, set_aside_only, write_audit, write_quarantine

STATE_DDL = f"generation INT, items BIGINT, {bloom.FILTER_DDL}"
COMPACT_EVERY = 16


@dataclass(frozen=True)
class Growth:
    """Sizes of the filter's generations."""

    first_items: int = 1_000_000
    fp_rate: float = 0.01

    def capacity(self, generation: int) -> int:
        return self.first_items << generation

    def size(self, generation: int) -> tuple[int, int]:
        """Bits and hash functions; half of the rate is left for the first generation, a quarter for the next."""
        return bloom.sized_in_lanes(self.capacity(generation), self.fp_rate / 2 ** (generation + 1))

    def blocks(self, held: dict[int, int]) -> int:
        """At most so many blocks are not empty, with so many items by generation."""
        return sum(min(items, self.size(generation)[0] // bloom.BLOCK_BITS) for generation, items in held.items())


class FilterLog:
    """The filter's entries and bases under one folder, by batch.

    Rows of an entry or base are blocks of a generation, and one row with a null block
    for each generation that says how many items went in.
    """

    def __init__(self, spark: SparkSession, folder: str):
        # Blocks are numbered by the lanes, so a log without them, or with others, is not found and stops the stream.
        self.spark, self.folder = spark, f"{folder}/lanes-{bloom.LANES}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def place(self, kind: str, batch_id: int) -> str:
        return f"{self.folder}/{kind}={batch_id}"

    def batches(self, kind: str) -> list[int]:
        """Batches that finished writing this kind, ascending."""
        if not self._files.exists(self._path(self.folder)):
            return []
        names = [entry.getPath().getName() for entry in self._files.listStatus(self._path(self.folder))]
        numbers = [int(name.split("=")[1]) for name in names if name.startswith(f"{kind}=")]
        return sorted(n for n in numbers if self._files.exists(self._path(f"{self.place(kind, n)}/_SUCCESS")))

    def base_before(self, batch_id: int) -> int:
        """The last base that a batch may read; -1 if it starts from nothing."""
        return max((n for n in self.batches("base") if n < batch_id), default=-1)

    def paths_before(self, batch_id: int) -> list[str]:
        """What makes up the filter as of the start of a batch, the base first. Batches count from 0 without gaps."""
        base, written = self.base_before(batch_id), self.batches("entry")
        lost = [n for n in range(base + 1, batch_id) if n not in written]
        if lost:
            raise FileNotFoundError(f"path does not exist: {self.place('entry', lost[0])}, without which old ids would pass as new")
        return [self.place("base", base)] * (base >= 0) + [self.place("entry", n) for n in range(base + 1, batch_id)]

    def read(self, paths: list[str]) -> DataFrame:
        """Entries and bases as they were written."""
        return self.spark.read.schema(STATE_DDL).parquet(*paths) if paths else self.spark.createDataFrame([], STATE_DDL)

    def before(self, batch_id: int) -> DataFrame:
        """The filter as of the start of a batch."""
        return folded(self.read(self.paths_before(batch_id)))

    def write(self, state: DataFrame, kind: str, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(self.place(kind, batch_id))

    def drop_old(self, batch_id: int) -> None:
        """Remove what no batch from this one on reads. Only the running batch can be repeated, and it reads from the last base before it."""
        base = self.base_before(batch_id)
        for kind, last in (("entry", base), ("base", base - 1)):
            for n in self.batches(kind):
                if n <= last:
                    self._files.delete(self._path(self.place(kind, n)), True)


def _counts(spark: SparkSession, held: dict[int, int]) -> DataFrame:
    """The rows that say how many items went in."""
    return spark.createDataFrame([(g, items, *[None] * (1 + len(bloom.WORDS))) for g, items in held.items()], STATE_DDL)


def _blocks(state: DataFrame) -> DataFrame:
    return state.filter("block is not null").select("generation", "block", *bloom.WORDS)


def folded(state: DataFrame) -> DataFrame:
    """One row per block and generation, and the items of each generation."""
    items = state.filter("block is null").groupBy("generation").agg(F.sum("items").alias("items"))
    nothing = [F.lit(None).cast("bigint").alias(name) for name in ("block", *bloom.WORDS)]
    blocks = bloom.merge(_blocks(state), keys=("generation",))
    return blocks.withColumn("items", F.lit(None).cast("bigint")).unionByName(items.select("generation", "items", *nothing))


def _base(blocks: DataFrame, held: dict[int, int], tasks: int) -> DataFrame:
    """The same for a large filter, whose items are known, sorted so that a generation is read without most of the others."""
    merged = bloom.merge(bloom.by_lane(blocks, tasks), keys=("_lane", "generation")).drop("_lane").sortWithinPartitions("generation")
    return merged.withColumn("items", F.lit(None).cast("bigint")).unionByName(_counts(blocks.sparkSession, held))


def _held(state: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Items by generation: of the whole filter, and of its base."""
    whole, base = {}, {}
    counts = state.filter("block is null").select("generation", "items", F.input_file_name().rlike("/base=[0-9]+/[^/]*$").alias("in_base"))
    for row in counts.collect():
        for held in (whole, base) if row.in_base else (whole,):
            held[row.generation] = held.get(row.generation, 0) + row["items"]
    return whole, base


def _one_each(rows: DataFrame, key: str) -> DataFrame:
    """One row per key. Each task lets one of a key pass before the shuffle, by a sort and without copies of all columns in an aggregate."""
    placed = rows.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(F.lit(1))))
    return placed.filter("_place = 1").drop("_place")


def accept_new(
    rows: DataFrame, state: DataFrame, held: dict[int, int], key: str, growth: Growth, method: str, whole: bool = False
) -> DataFrame:
    """One row per key that no generation of the filter may have seen. `whole` says that the state has a block once."""
    judged = _one_each(rows.filter(F.col(key).isNotNull()), key)
    blocks = {g: _blocks(state).filter(F.col("generation") == g).drop("generation") for g, items in held.items() if items}
    filled = growth.blocks(held)
    if filled * bloom.BLOCK_BYTES > bloom.BROADCAST_LIMIT_BYTES:
        tasks = bloom.partitions(filled, _tasks(rows.sparkSession))
        return bloom.in_none(judged, F.col(key), [(found, *growth.size(g)) for g, found in blocks.items()], tasks, method, whole)
    for generation, found in blocks.items():
        found = found if whole else bloom.merge(found)
        judged = bloom.might_contain(judged, F.col(key), found, *growth.size(generation), method)
        judged = judged.filter(~F.col("maybe_seen")).drop("maybe_seen")
    return judged


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _room(held: dict[int, int], fresh: int, growth: Growth) -> int:
    """The newest generation, or a new one if so many fresh keys would overfill it."""
    generation = max(held, default=0)
    while held.get(generation, 0) + fresh > growth.capacity(generation):
        generation += 1  # generations that are skipped stay empty
    return generation


def _entry(accepted: DataFrame, generation: int, key: str, growth: Growth, method: str) -> DataFrame:
    """The accepted keys as blocks of a generation."""
    blocks = bloom.build(accepted, F.col(key), *growth.size(generation), method)
    return blocks.select(F.lit(generation).alias("generation"), "block", *bloom.WORDS)


def bloom_writer(
    output: str, filters: str, key: str, growth: Growth = Growth(), method: str = "xxhash64", compact_every: int = COMPACT_EVERY
):
    """A `foreachBatch` function that appends new rows and logs their bits. Returns the accepted rows."""

    def write(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        log = FilterLog(spark, filters)
        log.drop_old(batch_id)
        paths = log.paths_before(batch_id)
        state = log.read(paths)
        held, in_base = _held(state)
        target = f"{output}/batch_id={batch_id}"
        accept_new(batch, state, held, key, growth, method, len(paths) == 1).write.mode("overwrite").parquet(target)
        accepted = spark.read.schema(batch.schema).parquet(target)
        fresh = accepted.count()
        generation = _room(held, fresh, growth)
        entry = _entry(accepted, generation, key, growth, method)
        held[generation] = held.get(generation, 0) + fresh
        tasks = bloom.partitions(growth.blocks(held), _tasks(spark))
        if growth.blocks(in_base) <= sum(held.values()) - sum(in_base.values()):
            log.write(_base(_blocks(state).unionByName(entry), held, tasks), "base", batch_id)
            return accepted
        log.write(entry.withColumn("items", F.lit(None).cast("bigint")).unionByName(_counts(spark, {generation: fresh})), "entry", batch_id)
        if (batch_id + 1) % compact_every == 0:
            log.write(_base(_blocks(log.read(log.paths_before(batch_id + 1))), held, tasks), "base", batch_id)
        return accepted

    return write


def start_bloom_ingest(
    messages: DataFrame, output: str, quarantine: str, audit: str, filters: str, checkpoint: str,
    growth: Growth = Growth(), every: str | None = None,
) -> StreamingQuery:
    """The ingest of `ingest.start_ingest` with the filter in place of exact state: same quarantine, same audit."""
    accept = bloom_writer(output, filters, "flight_id", growth)

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        batch.persist()
        try:
            accepted = accept(batch.filter("reason is null").select("flight.*"), batch_id)
            write_quarantine(batch, quarantine, batch_id)
            write_audit(batch, accepted, audit, batch_id, started)
        finally:
            batch.unpersist()

    rows = classified(messages)
    # Flight columns as one: a cache takes every column of a row by itself, with statistics of its values.
    flight = F.when(F.col("reason").isNull(), F.struct(*FLIGHT_COLUMNS)).alias("flight")
    rows = rows.select("reason", *set_aside_only("position", "raw"), flight)
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"processingTime": every} if every else {"availableNow": True})).start()
