"""Token counts of whole texts by a two-tier lookup, without shuffling pre-tokens.

Tier one is a table of frequent pre-tokens and their lengths in tokens, counted
on a bounded sample of rows and broadcast in compact form (one joined string and
one array of lengths). Tier two is each worker's own cache of the other
pre-tokens it has met; only what is in neither goes through the library, all
misses of a batch in one call. The tables decide speed alone, never a count.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaynet.llm.common import hash_order, map_rows, slices, texts_of
from delaynet.llm.vocabularies import CACHE_CHARS, CACHE_UNITS, marked_words, sentence_piece

SAMPLE_ROWS = 1000  # rows that the frequent table is counted on
SAMPLE_CHARS = 8000  # characters of each of them
TABLE_UNITS = 65_536  # most entries of the frequent table

Frequent = tuple[str, np.ndarray]
_SEPARATOR = "\x00"


def lengths_of(units: list[str], model: str) -> list[int]:
    """Tokens of each unit as the library counts them; the empty unit is a lone mark."""
    encoded = sentence_piece(model).encode(units, num_threads=1)
    return [len(ids) if unit else 1 for unit, ids in zip(units, encoded)]


def frequent_table(
    docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS, units: int = TABLE_UNITS,
) -> Frequent:
    """The most frequent units of a sample of about `sample_rows` rows, with their token counts.

    Rows are drawn by a fixed hash of the id, at the rate that gives the wanted
    number; rows without an id are not drawn.
    """
    rows = max(1, docs.count())
    drawn = F.pmod(hash_order(doc_id), F.lit(10**9)) < min(10**9, -(-(10**9) * sample_rows // rows))
    sample = docs.filter(F.col(doc_id).isNotNull() & drawn).select(F.substring(F.col(text), 1, SAMPLE_CHARS).alias("start"))
    sample = sample.limit(4 * sample_rows)  # should ids repeat
    counted = Counter()
    for row in sample.collect():
        counted.update(unit for unit in marked_words(row.start or "") if len(unit) <= CACHE_CHARS and _SEPARATOR not in unit)
    names = [unit for unit, _ in counted.most_common(units)]
    return _SEPARATOR.join(names), np.array(lengths_of(names, model) if names else [], dtype=np.uint16)


class _Lookup:
    """The worker's lengths: frequent units for good, others until the cache is full."""

    def __init__(self, model: str, frequent: Frequent):
        self._model = model
        joined, lengths = frequent
        self._frequent = dict(zip(joined.split(_SEPARATOR), lengths.tolist())) if len(lengths) else {}
        self._known = dict(self._frequent)

    def count(self, texts: list[str]) -> list[int]:
        if len(self._known) > CACHE_UNITS:
            self._known = dict(self._frequent)
        known = self._known
        units = [marked_words(text) for text in texts]
        found = [list(map(known.get, words)) for words in units]
        if misses := list({unit for words, sizes in zip(units, found) if None in sizes for unit, n in zip(words, sizes) if n is None}):
            new = dict(zip(misses, lengths_of(misses, self._model)))
            for words, sizes in zip(units, found):
                if None in sizes:
                    sizes[:] = [new[unit] if n is None else n for unit, n in zip(words, sizes)]
            known.update(item for item in new.items() if len(item[0]) <= CACHE_CHARS)
        return [sum(sizes) for sizes in found]


_LOOKUPS: dict[str, _Lookup] = {}


def worker_lookup(key: str, model: str, frequent) -> _Lookup:
    """The worker's lookup for one broadcast table; an older one makes room."""
    if key not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[key] = _Lookup(model, frequent.value)
    return _LOOKUPS[key]


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS, table_units: int = TABLE_UNITS,
) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` of every row, in place.

    Counts are those of the SentencePiece model without begin and end. A null
    text counts as empty: no bytes and no tokens. Repeated rows and null ids are
    rows like any other; other columns are not read.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, model, doc_id, text, sample_rows, table_units))
    key = uuid.uuid4().hex
    step = 400_000  # characters that are split into units at once

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        lookup = worker_lookup(key, model, frequent)
        texts = [content or "" for content in texts_of(batch)]
        counts = [n for low, high in slices(list(map(len, texts)), step) for n in lookup.count(texts[low:high])]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, type=pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text).cast("string").alias("text"),
    )
    counted = map_rows(rows, count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
