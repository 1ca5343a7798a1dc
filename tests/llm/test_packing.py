import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from delaynet.llm.packing import pack, pieces, plan
from delaynet.llm.queries import QUERIES, byte_bpe_files
from delaynet.llm.vocabularies import byte_bpe

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


def fixed(ids):
    return np.array(ids, dtype="<u4").tobytes()


@settings(deadline=None, max_examples=400)
@given(st.lists(st.sampled_from(list(" \n\t.,!'sab1é中😀▁\x1c 　") + ["<|endoftext|>", "  ", "'ll"]), max_size=30).map("".join))
def test_ids_are_those_of_the_library(text):
    assert byte_bpe(*byte_bpe_files().values()).encode(text) == fixed(reference(text)[:-1])


@pytest.mark.parametrize("kind", ["uniform", "skewed", "large", "one length", "tiny", "none"])
def test_plan_places_every_piece_once_without_gaps(kind):
    rng = np.random.default_rng(3)
    lengths = {
        "uniform": rng.integers(1, 257, 5000), "skewed": np.minimum(256, rng.lognormal(3.5, 1.0, 8000).astype(int) + 1),
        "large": rng.integers(120, 257, 500), "one length": np.full(777, 100), "tiny": np.array([5]), "none": np.zeros(0, int),
    }[kind]
    counts = np.bincount(lengths, minlength=257)
    found = plan(counts, 256)
    order = np.sort(lengths)
    rank = np.arange(len(order)) - np.searchsorted(order, order)
    sequence, offset = found.place(order, rank) if len(order) else (order, order)
    by = np.lexsort((offset, sequence))
    for group in np.split(by, np.flatnonzero(np.diff(sequence[by])) + 1):
        assert offset[group].tolist() == [0, *np.cumsum(order[group])[:-1].tolist()][: len(group)]
        assert order[group].sum() <= 256
    if kind == "skewed":  # many short pieces fill every gap
        assert len(set(sequence.tolist())) <= -(-int(lengths.sum()) // 256) * 1.02 + 1
    if kind == "one length":
        assert len(set(sequence.tolist())) == -(-777 // 2)


def test_exact_complements_are_used_first():
    counts = np.zeros(101, dtype=int)
    counts[[60, 40, 70, 20, 10, 50, 30]] = [3, 3, 2, 2, 2, 1, 1]
    found = plan(counts, 100)
    assert found.sequence.max() + found.times.max() >= 1
    total = sum(length * n for length, n in enumerate(counts))
    order = np.repeat(np.arange(101), counts)
    rank = np.arange(len(order)) - np.searchsorted(order, order)
    sequence, _ = found.place(order, rank)
    assert len(set(sequence.tolist())) == -(-total // 100)


def check(rows, texts, capacity):
    by_sequence = {}
    found = {}
    for doc, piece, start, length, crc, sequence, offset in rows:
        by_sequence.setdefault(sequence, []).append((offset, length))
        found.setdefault(doc, []).append((piece, start, length, crc))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    expected = {}
    for doc, text in texts:
        ids = reference(text)
        first = (len(ids) - 1) % capacity + 1
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        expected.setdefault(doc, []).extend((i, a, b - a, zlib.crc32(fixed(ids[a:b]))) for i, (a, b) in enumerate(zip(bounds, bounds[1:])))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    return len(by_sequence)


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def test_awkward_rows(awkward):
    cut = pieces(awkward, **byte_bpe_files(), capacity=64)
    rows = pack(cut, capacity=64, carry={"ids_crc32": F.crc32("ids")}).select(*COLUMNS).collect()
    check([tuple(r) for r in rows], [(r.doc_id, r.text) for r in awkward.collect()], 64)


def test_operator_returns_the_ids(awkward):
    rows = pack(pieces(awkward.filter("doc_id = 10"), **byte_bpe_files())).collect()
    assert [r.ids for r in rows] == [fixed(reference("ümläut straße 東京 😀 end"))]


def test_no_documents(no_documents):
    assert pack(pieces(no_documents, **byte_bpe_files())).collect() == []


def test_query_packs_all_documents(spark, sf_dir):
    rows = [tuple(r) for r in QUERIES["op10_best_fit_packing"](spark, sf_dir).select(*COLUMNS).collect()]
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used = check(rows, texts, 2048)
    tokens = sum(r[3] for r in rows)
    halves = sum(r[3] > 1024 for r in rows)
    assert used <= max(halves, -(-tokens // 2048)) * 1.03 + 1
