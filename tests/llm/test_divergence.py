import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from delaynet.llm import divergence
from answers import plain

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), word) for word in TERM.findall(text or "")]


def brute(rows, least=3, top=200):
    """The audit of (lang, source, text) in Python's whole numbers, share by share."""
    rows = [tuple(x or "" for x in row) for row in rows]
    out = []
    for lang in {row[0] for row in rows}:
        docs = [(source, terms(text)) for name, source, text in rows if name == lang]
        holds = {}
        for _, words in docs:
            for word in set(words):
                holds[word] = holds.get(word, 0) + 1
        kept = sorted(word for word, n in holds.items() if n >= least)

        def shares(words):
            n = [words.count(term) for term in kept]
            return [1 + 10**9 * (x + 1) // (sum(n) + len(kept)) for x in n], n

        q, _ = shares([word for _, words in docs for word in words])
        p = {source: shares([word for name, words in docs if name == source for word in words]) for source in {source for source, _ in docs}}
        for source, (own, n) in p.items():
            pair = [(-sum((a - b) ** 2 // b for a, b in zip(own, other)), name.encode(), name) for name, (other, _) in p.items() if name != source]
            term = [(-((a - b) ** 2 // b), word.encode(), word) for a, b, x, word in zip(own, q, n, kept) if x and a > b]
            for part, values in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(values, 1)]
    return sorted(out)


def columns(df):
    return [tuple(r) for r in df.select("lang", "source", "text").collect()]


def test_awkward_table_against_brute_force(awkward):
    assert plain(divergence.audit(awkward)) == brute(columns(awkward))
    assert plain(divergence.audit(awkward, least_docs=1, top_terms=5)) == brute(columns(awkward), 1, 5)


def test_made_up_table_against_brute_force(spark):
    rng = random.Random(8)
    words = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefgh" * 3, "abcdefgh" * 3 + "x", "é", "東京", "Zürich", "ſ", "😀", "x1y", "A-b"]
    rows = [
        (rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "S3", "é", None]), " ".join(rng.choices(words, k=rng.randrange(30))))
        for _ in range(300)
    ] + [("xx", "only", "nothing kept"), ("yy", "s1", ""), ("yy", "s2", None), ("en", "bare", "12 34")]
    table = spark.createDataFrame(rows, "lang string, source string, text string").repartition(6)
    assert plain(divergence.audit(table)) == brute(rows)


def test_empty_table(no_documents):
    assert divergence.audit(no_documents).collect() == []


def test_query_against_sql(spark, sf_dir):
    found = plain(divergence.audit(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
        assert sorted(db.sql(divergence.AUDIT_SQL).fetchall()) == found


def test_pointers_are_sorted_by_their_terms():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abAB é東-") for _ in range(rng.randrange(60))) for _ in range(200)] + ["", "ab" * 5000, "ab" * 5000, "ab" * 4999 + "a"]
    data = [text.encode() for text in texts]
    offsets = np.cumsum([0, *map(len, data)])
    content = divergence._BYTES[np.frombuffer(b"".join(data), np.uint8)]
    starts, lengths = divergence.pointers(content, offsets)
    found = [bytes(content[a : a + n]) for a, n in zip(starts, lengths)]
    assert found == [word.encode() for text in texts for word in terms(text)]
    place = divergence.run_starts(content, starts, lengths)
    first = {}
    for at, word in enumerate(sorted(found)):
        first.setdefault(word, at)
    assert place.tolist() == [first[word] for word in found]


@pytest.mark.parametrize("cells", [4_000_000, 30, 1])
def test_pair_sums_in_blocks(monkeypatch, cells):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(divergence, "_CELLS", cells)
    bounds, size = [(0, 7), (7, 9)], rng.integers(1000, 10**11, 9)
    rows = []
    for _ in range(40):
        lang = int(rng.integers(2))
        groups = rng.permutation(np.arange(*bounds[lang]))[: rng.integers(1, 3)]
        rows.append({"lang": lang, "cells": [{"grp": int(g), "n": int(rng.integers(1, size[g]))} for g in sorted(groups)], "copies": int(rng.integers(1, 5))})
    schema = pa.schema([("lang", pa.int32()), ("cells", pa.list_(pa.struct([("grp", pa.int32()), ("n", pa.int64())]))), ("copies", pa.int64())])
    found = {}
    for out in divergence.pair_sums(pa.RecordBatch.from_pylist(rows, schema), bounds, size):
        for row in out.to_pylist():
            found[row["grp"], row["other"]] = found.get((row["grp"], row["other"]), 0) + (row["high"] << 30) + row["low"]
    wanted = {}
    for row in rows:
        counts = {cell["grp"]: cell["n"] for cell in row["cells"]}
        share = {g: 1 + 10**9 * (counts.get(g, 0) + 1) // int(size[g]) for g in range(*bounds[row["lang"]])}
        for a in share:
            for b in share:
                wanted[a, b] = wanted.get((a, b), 0) + row["copies"] * ((share[a] - share[b]) ** 2 // share[b])
    assert found == wanted
