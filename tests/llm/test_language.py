import random
import zlib

import numpy as np
import pytest

from delaynet.llm import language
from delaynet.llm.queries import QUERIES


def phrases(text, sample):
    """Longest-match phrases, found by plain search."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at : at + size] in sample:
            size += 1
        at += max(1, size - 1)
        count += 1
    return count


@pytest.mark.parametrize("seed", range(4))
def test_parse_counts_the_longest_phrases(seed):
    rng = np.random.default_rng(seed)
    letters = "abc" if seed % 2 else "abcdefgh"
    make = lambda n: "".join(rng.choice(list(letters), n))
    samples = {"x": [make(300)], "y": [make(200), make(50)]}
    model = language.train(samples, total=10_000)
    table = language.symbol_table(model.letters)
    texts = [make(n) for n in (1, 2, 17, 90)] + ["z" + make(5)]
    found = model.parse([language.symbols(t, table) for t in texts])
    for row, name in enumerate(model.languages):
        sample = " ".join(samples[name]) + " "
        assert found[row].tolist() == [phrases(t, sample) for t in texts]


def test_symbols_fold_case_and_blanks():
    table = language.symbol_table(list("abc"))
    assert language.symbols("  A--b  C\n", table).tolist() == [2, 0, 3, 0, 4]
    assert language.symbols("ż1é", table).tolist() == [1, 0, 1]
    assert language.symbols("12 !!", table).tolist() == []


def test_blocks_bound_long_texts():
    model = language.train({"x": ["abcabc" * 50]}, total=1000)
    table = language.symbol_table(model.letters)
    long = language.symbols("abc" * 5000, table)
    assert model.parse([long])[0, 0] >= -(-len(long) // language.BLOCK)


def test_awkward_rows(awkward):
    model = language.fit(awkward)
    rows = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(awkward, model).collect()}
    by_id = {}
    for doc_id, pred, score in rows:
        assert 0 <= score <= 1
        by_id.setdefault(doc_id, set()).add(pred)
    assert by_id[3] == by_id[4] == by_id[5] == by_id[6] == {"und"}
    assert by_id[1] == by_id[2] != {"und"}
    kept = language.keep_identified(awkward, model)
    assert kept.columns == awkward.columns
    assert {3, 4, 5, 6}.isdisjoint({r.doc_id for r in kept.collect()})
    assert kept.filter("doc_id = 9").count() == 3


def invented(seed, letters, words=400):
    """Sentences over 150 words that are drawn from these letters."""
    rng = np.random.default_rng(seed)
    known = ["".join(rng.choice(letters, rng.integers(2, 8))) for _ in range(150)]
    return lambda: " ".join(rng.choice(known, words))


def test_many_scripts_and_languages():
    ranges = [(0x3B1, 24), (0x430, 32), (0x561, 38), (0x5D0, 27), (0x10D0, 33), (0x905, 53), (0xE01, 46), (0x4E00, 900), (0x61, 26), (0x1200, 200)]
    speakers = {
        f"{at}-{i}": invented(100 * at + i, [c for c in map(chr, range(low, low + n)) if c.isalpha()])
        for at, (low, n) in enumerate(ranges) for i in range(4)
    }
    model = language.train({name: [speak() for _ in range(8)] for name, speak in speakers.items()}, total=6000)
    found, *_ = language.predict(model, [speak() for speak in speakers.values()])
    assert found == list(speakers)
    assert (model.phrase_bits > np.log2(5000)).all()  # the bound does not shrink with the number of languages
    assert np.count_nonzero(model.class_bits.any(axis=1)) == 8  # the two largest scripts have classes


def test_long_texts_are_learned_from(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 != 0][:20]
    one, other = invented(1, list("abcdefgh")), invented(2, list("abcdefgh"), 9000)
    docs = spark.createDataFrame([(i, other() if i % 2 else one(), "xy"[i % 2]) for i in ids], "doc_id bigint, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["x", "y"]
    assert language.predict(model, [one(), other()])[0] == ["x", "y"]


def test_every_distinct_text_gives_a_slice():
    texts = ["ab " * 3000] * 5 + ["cd " * 3000, "ef " * 3000, "gh", "ij"]
    table = language.symbol_table(list("abcdefghij"))
    found = language.sample_of(texts, table, 3000)
    counted = np.bincount(found, minlength=12)
    assert len(found) <= 3000 and counted[2:].min() > 0
    assert counted[2] > 300 and abs(counted[[2, 4, 6]] - counted[2]).max() <= 2
    assert 2990 <= len(found)
    whole = language.sample_of(["ab", "cd", "ab"], table, 3000)
    assert whole.tolist() == [2, 3, 0, 4, 5, 0]


def test_copies_and_one_id_with_many_rows(spark):
    held = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 5 != 0]
    alike = spark.createDataFrame([(held[0], "one text of which there are many copies", "x")] * 4000, "doc_id bigint, text string, lang string")
    others = [(i, f"{'qrstuvw'[i % 7]} text {chr(97 + i % 26) * 3}", "x") for i in held[1:400]]
    docs = alike.unionByName(spark.createDataFrame(others, alike.schema))
    model = language.fit(docs, sample_rows=100)
    assert set("qrstuvw") <= {c for c, own in zip(model.letters, model.own[0][2:]) if own > 1}


def test_nothing_to_learn_from(awkward, no_documents):
    model = language.fit(no_documents)
    assert {r.lang_pred for r in language.identify(awkward, model).collect()} == {"und"}
    assert language.keep_identified(awkward, model).count() == awkward.count()
    assert language.identify(no_documents, model).collect() == []


def test_short_junk_is_rejected(spark):
    speak = invented(1, list("abcdefghijklmnopqrstuvwxyz"))
    model = language.train({"x": [speak() for _ in range(20)]})
    rng, text = np.random.default_rng(2), speak()
    good = [text[:n] for n in (1, 2, 5, 20, 60, 150, 199, 200, 2000)]
    junk = ["".join(rng.choice(list(letters), n)) for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзик") for n in (60, 150, 199, 200, 2000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + junk)], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in language.keep_identified(docs, model).collect()) == list(range(len(good)))


def test_held_out_rows_are_not_learned_from(spark, awkward):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = spark.createDataFrame([(i, "abc def", "en") for i in held], "doc_id bigint, text string, lang string")
    assert language.fit(docs).languages == []


def test_query_is_right_on_held_out_documents(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op1_language_id"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) >= 0.95


def test_thousands_of_labels_besides_real_ones(spark):
    rng = random.Random(6)
    rows = [(i, "noise " + "".join(rng.choices("abcdefgh", k=20)), f"dirty{i}") for i in range(3000)]
    tongues = {f"real{n:02d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(30)] for n in range(40)}
    for name, words in tongues.items():
        rows += [(len(rows) + k, " ".join(rng.choices(words, k=40)), name) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs, most_languages=60)
    assert len(model.languages) <= 60 and set(tongues) <= set(model.languages)
    truth = {row[0]: row[2] for row in rows}
    found = [(truth[r.doc_id], r.lang_pred) for r in language.identify(docs, model).filter("held_out").collect()]
    real = [a == b for a, b in found if a.startswith("real")]
    assert sum(real) >= 0.95 * len(real) > 50
