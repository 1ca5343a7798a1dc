import hashlib

import numpy as np
import pytest

from delaynet.llm import syncmers
from delaynet.llm.queries import QUERIES


def reference_places(text, k, s):
    points = np.array([ord(c) for c in text], dtype=np.uint64)
    inner = syncmers._grams(points, s).tolist()
    out = []
    for at in range(len(text) - k + 1):
        window = inner[at : at + k - s + 1]
        if min(window) in (window[0], window[-1]):
            out.append(at)
    return out


@pytest.mark.parametrize("k, s", [(16, 6), (6, 3), (5, 5), (9, 2)])
def test_chosen_places(k, s):
    rng = np.random.default_rng(k)
    text = "".join(rng.choice(list("abcdé 東"), 500))
    points = np.array([ord(c) for c in text], dtype=np.uint64)
    assert syncmers.closed_syncmers(points, k, s)[1].tolist() == reference_places(text, k, s)


def test_anchors_do_not_depend_on_their_surroundings():
    rng = np.random.default_rng(0)
    passage, a, b = ("".join(rng.choice(list("abcdefgh"), n)) for n in (400, 300, 251))
    inside = lambda text, at: {(h, p - at) for h, p in zip(*map(np.ndarray.tolist, syncmers.anchors(text))) if at <= p <= at + 400 - syncmers.K}
    assert inside(a + passage + b, 300) == inside(b + passage + a, 251) != set()


def test_every_window_has_an_anchor():
    rng = np.random.default_rng(1)
    _, places = syncmers.anchors("".join(rng.choice(list("abcdefgh"), 3000)))
    assert np.diff(places).max() <= syncmers.K - syncmers.S + 1


def test_likeness():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(600)]
    text, other = " ".join(words), " ".join(words[::-1][:300])
    near = lambda x, y: syncmers.likeness(syncmers.fingerprint(x), syncmers.fingerprint(y))
    unrelated = "".join(rng.choice(list("stuvwxyz "), 4000))
    assert near(text, text) == near("", "") == near("", None) == 1.0
    assert near(text, "") == near(text, unrelated) == 0.0
    assert 0.35 < near(text, syncmers.edited(text, unrelated)) < 0.85
    assert near(text, " ".join(words[:300] + words[301:])) > 0.8
    assert near(text, other) < 0.3  # the same words, but in another order
    assert near(text, text[:2000]) == near(text[:2000], text)
    assert near("short text", "short text!") > 0.2
    assert syncmers.written(syncmers.fingerprint(text)) == syncmers.written(syncmers.fingerprint(str(text)))


def test_one_character_across_the_border_of_short_texts():
    rng = np.random.default_rng(3)
    near = lambda x, y: syncmers.likeness(syncmers.fingerprint(x), syncmers.fingerprint(y))
    for _ in range(20):
        text = " ".join("".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(40))
        for size in (syncmers.SHORT - 10, syncmers.SHORT, syncmers.SHORT + 10):
            assert near(text[:size], text[: size - 1]) == near(text[: size - 1], text[:size]) > 0.85
        assert near(text[:150], text[:150]) == 1.0
        assert near(text[:250], text[:199][::-1]) < 0.2


def expected(rows):
    """By id (rows without one first), ties by text; each with the row after it."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        changed = syncmers.edited(text, following)
        own, edit, after = map(syncmers.fingerprint, (text, changed, following))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((key, len(text), digest, syncmers.written(own), syncmers.written(edit), syncmers.likeness(own, edit), syncmers.likeness(own, after)))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_awkward_rows(awkward, size):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted((tuple(r) for r in syncmers.compare_neighbours(awkward, rows_per_range=size).collect()), key=str) == expected(rows)


def test_one_row_and_none(spark, no_documents):
    one = spark.createDataFrame([(3, "abcdefgh")], "doc_id bigint, text string")
    assert [tuple(r) for r in syncmers.compare_neighbours(one).collect()] == expected([(3, "abcdefgh")])
    assert syncmers.compare_neighbours(no_documents).collect() == []


def test_query_over_all_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op6_closed_syncmers"](spark, sf_dir).collect()), key=str) == expected(rows)
