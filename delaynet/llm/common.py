"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters of text that one step of an operator works on at a time. Long rows
# go through in pieces or alone, so a task's memory does not follow batch sizes.
STEP_CHARS = 1_000_000
BATCH_BYTES = 4 << 20  # of one Arrow batch
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def hash_order(column: str) -> Column:
    """A fixed pseudo-random order of rows by their key, the same in every run."""
    return F.xxhash64(F.col(column).cast("string"), F.lit("order"))


def unused(rows: DataFrame, name: str) -> str:
    """A column name that `rows` does not have."""
    while name in rows.columns:
        name += "_"
    return name


def slices(lengths: list[int], budget: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows with at most `budget` characters, one row at least."""
    start = total = 0
    for at, size in enumerate(lengths):
        if at > start and total + size > budget:
            yield start, at
            start, total = at, 0
        total += size
    if start < len(lengths):
        yield start, len(lengths)


def map_batches(rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` with batches of at most BATCH_BYTES.

    That is a setting of the session, not of one query, so a larger value there is
    lowered for good: a task holds some batches as Arrow data and as Python strings
    at once, next to Spark's own copy.
    """
    conf = rows.sparkSession.conf
    if not 0 < _bytes(conf.get(_BATCH_SETTING)) <= BATCH_BYTES:
        conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
    return rows.mapInArrow(function, schema)


def _bytes(text: str) -> int:
    """Bytes that a size setting names."""
    digits = text.strip().lower().removesuffix("b")
    unit = "kmgt".find(digits[-1:]) + 1 if digits[-1:].isalpha() else 0
    return int(digits[:-1] if unit else digits) << 10 * unit


def map_rows(rows: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """`function` over Arrow batches in the tasks that hold them, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return map_batches(rows, run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(column).to_pylist()
