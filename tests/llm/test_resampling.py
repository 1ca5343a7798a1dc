import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from delaynet.llm import resampling
from answers import plain

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target, share=5, least=20):
    """Rows as the definition says, ties of equal ids by features and weight."""
    rows = [(i, *features(text)) for i, text in docs]
    s, t = Counter(b for *_, found in rows for b in found), Counter(b for text in target for b in features(text)[1])
    S, T = s.total() + 10_000, t.total() + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * S / ((s[b] + 1) * T))) for b in range(10_000)]
    scored = []
    for i, n, found in rows:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        scored.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    ranks = {}
    for rank, row in enumerate(able[: share * len(able) // 100], 1):
        ranks.setdefault(row, []).append(rank)
    return [(i, f, w, score, ranks[row].pop() if ranks.get(row) else None) for row in scored for i, _, f, w, score in [row]]


def as_text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("share", [5, 60, 100])
def test_awkward_table_against_brute_force(spark, awkward, share):
    target = ["alpha beta gamma delta alpha beta", None, "", "straße 東京 no words here"]
    benchmark = spark.createDataFrame([(x, 7) for x in target], "text string, weight int")
    found = resampling.resample(awkward, benchmark, share=share, least_words=4).collect()
    wanted = brute([(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()], target, share, 4)
    assert as_text(map(tuple, found)) == as_text(wanted)


def test_documents_against_brute_force(spark, sf_dir):
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    found = plain(resampling.resample(docs, benchmark))
    wanted = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in benchmark.collect()])
    assert as_text(found) == as_text(wanted)
    assert sum(row[4] is not None for row in found) == 5 * sum(features(r.text)[0] >= 20 for r in docs.collect()) // 100


def test_rows_equal_in_everything_get_ranks_of_their_own(spark):
    docs = spark.createDataFrame([(1, "one two three")] * 50 + [(2, "four five six")], "doc_id bigint, text string")
    found = resampling.resample(docs.repartition(5), docs.limit(0), share=100, least_words=2).collect()
    assert sorted(r.rank for r in found) == list(range(1, 52))


def test_empty_tables(spark, no_documents):
    assert resampling.resample(no_documents, no_documents).collect() == []


def test_pieces_change_nothing(monkeypatch):
    text = "Ein Wort, two  words\nthree4 fünf-sechs " * 40 + "x" * 500 + " end"
    whole = resampling.Windows().of(text)
    for size in (1, 7, 100, 10_000):
        monkeypatch.setattr(resampling, "_pieces", lambda t, size=size: list(_cut(t, size)))
        count, found = resampling.Windows().of(text)
        assert count == whole[0] and sorted(found) == sorted(whole[1])
    assert (whole[0], sorted(whole[1])) == (features(text)[0], sorted(features(text)[1]))


_cut = resampling._pieces


def test_split_takes_the_words_of_the_pattern():
    text = "".join(map(chr, range(0x250))) + "  é東京 İ ſ K 😀x `{|}~ \x7f a\x80b"
    found = [word for word, _ in resampling.Windows().split.pre_tokenize_str(resampling.lowered(text))]
    assert found == WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def test_gains_of_empty_counts_are_none():
    assert not resampling.gains(np.zeros(10, np.int64), np.zeros(10, np.int64)).any()
