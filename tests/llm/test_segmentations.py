import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from delaynet.llm import segmentations as sg
from delaynet.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def all_segmentations(unit, words):
    """Every segmentation of a unit with its log chance, by recursion over the library's pieces."""
    text, out = sg.SPACE + unit.replace(" ", sg.SPACE), []

    def go(at, pieces, weight):
        if at == len(text):
            out.append((tuple(pieces), weight))
            return
        single = False
        for end in range(at + 1, min(len(text), at + words.longest) + 1):
            number = LIBRARY.piece_to_id(text[at:end])
            if number > 2 and not LIBRARY.is_byte(number):
                single |= end == at + 1
                go(end, [*pieces, number], weight + words.weight[number])
        if not single:
            size = len(text[at].encode())
            go(at + 1, [*pieces, words.size + ord(text[at])], weight + words.byte_weight * size)

    go(0, [], 0.0)
    total = np.logaddexp.reduce([w for _, w in out])
    return {pieces: weight - total for pieces, weight in out}


@pytest.fixture(scope="module")
def store():
    return sg.Lattices(sg.vocabulary(MODEL, 0.3))


def both(units, store):
    """Chances of all segmentations of a text of units."""
    found = {(): 0.0}
    for unit in units:
        found = {a + b: x + y for a, x in found.items() for b, y in all_segmentations(unit, store.words).items()}
    return found


@pytest.mark.parametrize("units", [["the", "of"], ["é東", " a"], ["ing", "", "x"]])
def test_samples_follow_the_chances_without_replacement(store, units):
    chances = both(units, store)
    n = 6000
    found = sg.top_samples(store, [units] * n, sg._mixed(np.arange(n, dtype=np.uint64)), 3)
    for samples in found[:200]:
        assert len({tuple(s[0].tolist()) for s in samples}) == len(samples) == min(3, len(chances))
        assert all(abs(s[1] - chances[tuple(s[0].tolist())]) < 1e-9 for s in samples)
        assert [s[2] for s in samples] == sorted((s[2] for s in samples), reverse=True)
    first = Counter(tuple(s[0][0].tolist()) for s in found)
    second = Counter(tuple(tuple(x[0].tolist()) for x in s[:2]) for s in found)
    for pieces, log in chances.items():
        p = np.exp(log)
        assert abs(first[pieces] / n - p) < 4.5 * np.sqrt(p * (1 - p) / n) + 1e-3
    for (a, b), times in second.most_common(5):
        p = np.exp(chances[a] + chances[b]) / -np.expm1(chances[a])
        assert abs(times / n - p) < 4.5 * np.sqrt(p * (1 - p) / n) + 1e-3
    # Weighed by inclusion, the chances of the samples add up to one.
    assert abs(np.mean([sum(np.exp(s[1]) / s[3] for s in samples) for samples in found]) - 1) < 0.05


def test_all_segmentations_come_in_the_end(store):
    chances = both(["of"], store)
    (samples,) = sg.top_samples(store, [["of"]], np.array([7], np.uint64), 100)
    assert {tuple(s[0].tolist()) for s in samples} == set(chances)
    assert all(s[3] == 1.0 for s in samples)


def test_samples_depend_on_the_row_alone(store):
    texts = [["alpha", "beta"] * 20, ["x"], [], ["gamma"] * 3]
    keys = np.array([5, 6, 7, 8], np.uint64)
    together = sg.top_samples(store, texts, keys, 3)
    fresh = sg.Lattices(sg.vocabulary(MODEL, 0.3))
    alone = [sg.top_samples(fresh, [t], keys[i : i + 1], 3)[0] for i, t in enumerate(texts)]
    assert [[(s[0].tolist(), *s[1:]) for s in x] for x in together] == [[(s[0].tolist(), *s[1:]) for s in x] for x in alone]
    assert [len(x) for x in together][1:3] == [1 if len(both(["x"], store)) == 1 else min(3, len(both(["x"], store))), 1]


def test_pieces_across_word_starts_are_refused(monkeypatch):
    class Library:
        is_control = is_unknown = is_byte = staticmethod(lambda number: False)
        get_score = staticmethod(lambda number: -float(number))
        get_piece_size = staticmethod(lambda: 3)
        id_to_piece = staticmethod(lambda number: ["a", "\u2581\u2581b", "a\u2581b"][number])

    monkeypatch.setattr(sg, "sentence_piece", lambda model: Library())
    with pytest.raises(ValueError, match="start of a word"):
        sg.Vocabulary("any", 0.5)


def test_decoding_in_steps(monkeypatch):
    letters = sg.Decoder([b" a", b"", "\u6771".encode(), b"\xf0", b"bc"])
    ids = np.array([0, 4, 1, 2, 4, 3, 0] * 5)
    whole = letters.text(ids)
    assert whole == b"".join([b" a", b"bc", b"", "\u6771".encode(), b"bc", b"\xf0", b" a"] * 5)[1:].decode("utf-8", "replace")
    monkeypatch.setattr(sg.Decoder, "STEP", 3)
    assert letters.text(ids) == whole and letters.text(ids[:0]) == ""


def test_shrinking_keeps_the_frequent_words(store):
    texts = [["alpha", "beta", "alpha", "rare"], ["beta", "gamma", "éé", "gamma"], ["alpha"]]
    keys = np.array([1, 2, 3], np.uint64)
    before = sg.top_samples(store, texts, keys, 3)
    small = sg.Lattices(sg.vocabulary(MODEL, 0.3))
    sg.top_samples(small, texts, keys, 3)
    small.shrink(2)
    assert len(small.known) == 2 and "alpha" in small.known and "rare" not in small.known
    again = sg.top_samples(small, texts, keys, 3)
    assert [[(s[0].tolist(), *s[1:]) for s in x] for x in again] == [[(s[0].tolist(), *s[1:]) for s in x] for x in before]
    small.shrink(0)
    assert not small.known


def normal(text):
    return (text or "").replace(sg.SPACE, " ")


def test_awkward_rows(awkward):
    rows = sg.decoded(sg.sampled(awkward, MODEL, samples=3), MODEL).collect()
    texts = Counter((r.doc_id, normal(r.text)) for r in awkward.collect())
    assert Counter((r.doc_id, r.decoded) for r in rows if r["sample"] == 1) == texts
    for r in rows:
        assert (r.doc_id, r.decoded) in texts
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens and LIBRARY.decode(ids) == r.decoded
        assert 0 <= r.inclusion <= 1
    assert {(r["sample"], r.n_tokens, r.inclusion) for r in rows if r.doc_id == 3} == {(1, 0, 1.0)}


def test_no_rows(spark, no_documents):
    assert sg.sampled(no_documents, MODEL).collect() == []
    null = spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")
    assert [r.decoded for r in sg.decoded(null, MODEL).collect()] == [None]


def test_query_round_trip(spark, sf_dir):
    texts = {r.doc_id: zlib.crc32(normal(r.text).encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op5_sampled_segmentations"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert all(texts[r.doc_id] == r.text_crc32 for r in rows)
    pairs = Counter((r.doc_id, r.ids_crc32) for r in rows)
    assert max(pairs.values()) == 1
