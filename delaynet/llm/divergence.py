"""How far the word counts of each source of a language are from the others'.

Terms are counted by sorting pointers. In a shard, which is one Arrow batch, a pointer
goes to the first byte of each term, in the buffer that Arrow holds the texts in. The
pointers are sorted by what they point at, eight bytes at a time and slice by slice, as
multikey quicksort does with single letters: a slice of pointers that agree so far is
cut by the next eight bytes, and those of one pointer or of ended terms are left alone.
Runs of equal terms then give occurrences and documents for each group of language and
source; both add up over shards.

A language keeps the terms that enough of its documents hold. Shares are smoothed by
one, in whole billionths, and compared by (p - q)^2 / q in whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaynet.llm.common import map_batches
from delaynet.session import materialize

LEAST_DOCS = 3
UNIT = 1_000_000_000  # shares are counted in billionths
TOP_TERMS = 200
_STEP = 8  # bytes that a round of the sort looks at
_CELLS = 4_000_000  # numbers that a step of the pair sums works on
_LOW_BITS = 30  # pair sums are added up in two parts, which stay within 64 bits for billions of terms


def _term_bytes() -> np.ndarray:
    """By byte: what it counts as inside a term (A-Z as a-z, others from 0x80 as themselves), 0 between terms."""
    table = np.arange(256, dtype=np.uint8)
    table[:0x80] = 0
    table[ord("a") : ord("z") + 1] = table[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


_BYTES = _term_bytes()


def pointers(content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every term in `content`, the bytes of texts that begin at `offsets`; terms end with their text."""
    inside = np.r_[False, content != 0, False]
    borders = np.zeros(len(content) + 1, dtype=bool)
    borders[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | borders))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | borders))
    return starts, ends - starts


def _digits(content: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The next eight bytes at each pointer as a number; zeros behind the end of a term."""
    every = np.ndarray(len(content) - _STEP + 1, dtype=">u8", buffer=content, strides=(1,))
    left = np.clip(lengths, 0, _STEP).astype(np.uint64)
    kept = every[np.minimum(starts, len(every) - 1)].astype(np.uint64) >> (np.uint64(8) * (np.uint64(_STEP) - np.maximum(left, np.uint64(1))))
    return np.where(left == 0, np.uint64(0), kept << (np.uint64(8) * (np.uint64(_STEP) - np.maximum(left, np.uint64(1)))))


def run_starts(content: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each pointer, the place in sorted order at which the run of its term begins."""
    content = np.r_[content, np.zeros(_STEP, dtype=np.uint8)]
    place, active, depth = np.zeros(len(starts), dtype=np.int64), np.arange(len(starts)), 0
    while len(active):
        digits = _digits(content, starts[active] + depth, lengths[active] - depth)
        order = np.lexsort((digits, place[active])) if depth else np.argsort(digits)
        active, digits = active[order], digits[order]
        of_slice = place[active]
        new_slice = np.r_[True, of_slice[1:] != of_slice[:-1]]
        new_run = new_slice | np.r_[True, digits[1:] != digits[:-1]]
        at = np.arange(len(active))
        place[active] = of_slice + np.maximum.accumulate(at * new_run) - np.maximum.accumulate(at * new_slice)
        first = np.flatnonzero(new_run)
        sizes = np.repeat(np.diff(np.r_[first, len(active)]), np.diff(np.r_[first, len(active)]))
        active = active[(sizes > 1) & (digits & np.uint64(0xFF) != 0)]
        depth += _STEP
    return place


def _strings(content: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The terms behind pointers."""
    ends = np.r_[0, np.cumsum(lengths)]
    places = np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(content[places]))])


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is there."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[first], np.diff(np.r_[first, len(keys)])


def count_shard(batch: pa.RecordBatch, numbers: dict[tuple[str, str], int]) -> pa.RecordBatch:
    """`grp, term, n, docs` of the rows `lang, source, text` in one batch; no value is null. `numbers` has the groups."""
    texts = batch.column("text").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    content, offsets = _BYTES[content], offsets - offsets[0]
    starts, lengths = pointers(content, offsets)

    of_doc = np.array([numbers[key] for key in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())], dtype=np.int64)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    place = run_starts(content, starts, lengths)
    heads = np.zeros(len(place), dtype=np.int64)
    heads[place] = 1
    run = np.cumsum(heads)[place] - 1
    cells, n = _counted(run * len(numbers) + of_doc[doc])
    held, _ = _counted(run * len(texts) + doc)  # each term once for a document
    _, docs = _counted(held // len(texts) * len(numbers) + of_doc[held % len(texts)])
    example = np.zeros(int(heads.sum()), dtype=np.int64)
    example[run] = np.arange(len(run))
    terms = _strings(content, starts[example], lengths[example]).take(pa.array(cells // len(numbers)))
    grp = pa.array((cells % len(numbers)).astype(np.int32))
    return pa.RecordBatch.from_arrays([grp, terms.cast(pa.string()), pa.array(n), pa.array(docs)], names=["grp", "term", "n", "docs"])


def _texts(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns as strings, empty where they are null, by the names that this module uses."""
    names = ("lang", "source", "text")
    return docs.select(*[F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name) for column, name in zip(columns, names)])


def groups_of(docs: DataFrame, lang: str = "lang", source: str = "source") -> list[tuple[str, str]]:
    """All groups of language and source in order; null values are empty ones.

    The audit has a row for every two groups of a language, so this list is short against its answer.
    """
    return [tuple(row) for row in _texts(docs, lang, source).distinct().orderBy("lang", "source").collect()]


def term_counts(docs: DataFrame, groups: list[tuple[str, str]], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """`grp, term, n, docs`: occurrences, and documents that hold the term, over all rows; `grp` is a place in `groups`.

    Null values are empty ones, every row is a document whether or not others equal it,
    and texts of any length are counted whole. Other columns are not read.
    """
    numbers = docs.sparkSession.sparkContext.broadcast({group: at for at, group in enumerate(groups)})

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield count_shard(batch, numbers.value)

    shards = map_batches(_texts(docs, lang, source, text), run, "grp int, term string, n bigint, docs bigint")
    return shards.groupBy("grp", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, lang: Column, least_docs: int = LEAST_DOCS) -> DataFrame:
    """`lang, term, total, cells` of the terms in enough documents of a language, which `lang` tells from `grp`.

    `cells` lists group and occurrences by group; a term has no more of them than the language has sources.
    """
    cells = F.array_sort(F.collect_list(F.struct("grp", "n"))).alias("cells")
    terms = counts.groupBy(lang.alias("lang"), "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), cells)
    return terms.filter(F.col("docs") >= least_docs).drop("docs")


def _share(n: Column, size: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / size), exact at any count."""
    parts = (n + 1).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", parts, size.cast("decimal(20,0)")) + 1


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def pair_sums(batch: pa.RecordBatch, bounds: list[tuple[int, int]], size: np.ndarray):
    """Sums of (p - q)^2 / q over the terms of a batch `lang, cells, copies`, in two parts, for all pairs of groups of a language.

    `bounds` has the groups of each language, from and to, and `size` what the shares of a
    group are divided by. A step holds the shares of a block of terms, and the sums of a
    block of groups.
    """
    langs = batch.column("lang").to_numpy()
    copies = batch.column("copies").to_numpy()
    cells = batch.column("cells")
    owner = np.repeat(np.arange(len(cells)), np.diff(cells.offsets.to_numpy()))
    values = cells.flatten()
    grp, n = values.field("grp").to_numpy(), values.field("n").to_numpy().astype(object)
    for lang in np.unique(langs):
        begin, end = bounds[lang]
        divisor, width = size[begin:end].astype(object), end - begin
        rows = np.flatnonzero(langs == lang)
        within = np.zeros(len(langs), dtype=np.int64)
        within[rows] = np.arange(len(rows))
        mine = np.flatnonzero(langs[owner] == lang)
        row, column = within[owner[mine]], grp[mine] - begin
        share = (UNIT * (n[mine] + 1) // divisor[column] + 1).astype(np.int64)
        absent = (UNIT // divisor + 1).astype(np.int64)
        tall, block = max(1, _CELLS // width), max(1, min(width, _CELLS // width))
        for first in range(0, width, block):
            last = min(width, first + block)
            high, low = (np.zeros((last - first, width), dtype=np.int64) for _ in range(2))
            for top in range(0, len(rows), tall):
                here = (row >= top) & (row < top + tall)
                shares = np.tile(absent, (min(tall, len(rows) - top), 1))
                shares[row[here] - top, column[here]] = share[here]
                many = copies[rows[top : top + tall]][:, None]
                for a in range(first, last):
                    gap = shares[:, a : a + 1] - shares
                    gap = gap * gap // shares
                    high[a - first] += ((gap >> _LOW_BITS) * many).sum(axis=0)
                    low[a - first] += ((gap & ((1 << _LOW_BITS) - 1)) * many).sum(axis=0)
            one = np.repeat(np.arange(begin + first, begin + last, dtype=np.int32), width)
            other = np.tile(np.arange(begin, end, dtype=np.int32), last - first)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (one, other, high.ravel(), low.ravel())], names=["grp", "other", "high", "low"])


def audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """`lang, source, part, item, value, rank` for every group of language and source.

    Part `pair` has all other sources of the language, by how far the group's shares are
    from theirs; part `term` the `top_terms` terms that the group has more of than its
    language, by how much. Higher values come first, equal ones by item.

    Null text, lang and source are empty ones, also as a group of their own; a group or
    language without kept terms is at distance 0 from its pairs and has no terms. Rows
    that repeat are documents each, texts of any length count whole, no documents give
    no rows. Other columns are not read.

    The answer itself has a row for every two sources of a language, and the work on
    pairs is as many steps for each distinct list of counts. The table of groups that is
    sent to all tasks is the root of that in size. Sorting a text takes about twenty
    times its bytes in the task that holds it.
    """
    spark = docs.sparkSession
    groups = groups_of(docs, lang, source)
    langs = sorted({name for name, _ in groups})
    number = {name: at for at, name in enumerate(langs)}
    bounds = [(0, 0)] * len(langs)
    for at, (name, _) in enumerate(groups):
        bounds[number[name]] = (bounds[number[name]][0] if at and groups[at - 1][0] == name else at, at + 1)
    named = spark.createDataFrame([(at, number[name], name, place) for at, (name, place) in enumerate(groups)], "grp int, lang_no int, lang string, source string")

    counts = term_counts(docs, groups, text, lang, source)
    kept = materialize(kept_terms(counts.join(F.broadcast(named.select("grp", "lang_no")), "grp"), F.col("lang_no"), least_docs), "terms")
    cells = kept.select("term", "total", F.inline("cells"))
    by_group = cells.groupBy("grp").agg(F.sum("n").alias("n"))
    by_lang = kept.groupBy(F.col("lang").alias("lang_no")).agg(F.count("*").alias("terms"), F.sum("total").alias("total_n"))
    sized = named.join(by_group, "grp", "left").join(by_lang, "lang_no", "left").na.fill(0, ["n", "terms", "total_n"])
    sized = materialize(sized.withColumns({"size": F.col("n") + F.col("terms"), "lang_size": F.col("total_n") + F.col("terms")}), "groups")

    shares = cells.join(F.broadcast(sized.select("grp", "size", "lang_size")), "grp")
    shares = shares.withColumns({"p": _share(F.col("n"), F.col("size")), "q": _share(F.col("total"), F.col("lang_size"))}).filter("p > q")
    order = Window.partitionBy("grp").orderBy(F.col("value").desc(), F.col("item"))
    terms = shares.select("grp", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)

    size = np.zeros(len(groups), dtype=np.int64)
    for row in sized.select("grp", "size").collect():
        size[row.grp] = row["size"]
    shared = spark.sparkContext.broadcast((bounds, size))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from pair_sums(batch, *shared.value)

    lists = kept.groupBy("lang", "cells").agg(F.count("*").alias("copies")).select("lang", "cells", "copies")
    sums = map_batches(lists, run, "grp int, other int, high bigint, low bigint").groupBy("grp", "other")
    exact = F.sum(F.col("high").cast("decimal(38,0)")) * F.lit(1 << _LOW_BITS).cast("decimal(10,0)") + F.sum(F.col("low").cast("decimal(38,0)"))
    other = named.select("lang_no", F.col("grp").alias("other"), F.col("source").alias("item"))
    two = named.select("lang_no", "grp").join(other, "lang_no").filter("grp <> other")
    pairs = two.join(sums.agg(exact.cast("bigint").alias("value")), ["grp", "other"], "left").select("grp", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms).join(F.broadcast(named), "grp").select("lang", "source", "part", "item", "value", "rank")


# The same rows from `documents`, for the sizes above.
AUDIT_SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
    SELECT r, lang, source, translate(unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM docs),
terms AS (SELECT lang, term, count(*)::HUGEINT AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
cells AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN terms USING (lang, term) GROUP BY lang, source, term),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS total_n FROM terms GROUP BY lang),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM cells GROUP BY lang, source),
sized AS (
    SELECT lang, source, coalesce(n, 0::HUGEINT) + coalesce(v, 0::HUGEINT) AS size, coalesce(total_n, 0::HUGEINT) + coalesce(v, 0::HUGEINT) AS lang_size
    FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN sums USING (lang, source) LEFT JOIN langs USING (lang)),
grid AS (
    SELECT s.lang, s.source, t.term, coalesce(c.n, 0::HUGEINT) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0::HUGEINT) + 1)) // s.size AS p,
        1 + (1000000000::HUGEINT * (t.total + 1)) // s.lang_size AS q
    FROM sized s JOIN terms t USING (lang) LEFT JOIN cells c USING (lang, source, term)),
summed AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM grid a JOIN grid b USING (lang, term) GROUP BY ALL),
ranked AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM sized a JOIN sized b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM grid WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 200
"""
