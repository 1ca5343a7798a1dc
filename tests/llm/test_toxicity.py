import zlib
from pathlib import Path

import numpy as np
import pytest

from delaynet.llm import toxicity
from delaynet.llm.queries import QUERIES

LABELS = "doc_id bigint, quality int, toxic int"


def made(n, seed=0):
    """Texts whose grade follows from the insults that they hold; grade 2 is the harsher word."""
    rng = np.random.default_rng(seed)
    common = [f"{a}{b}" for a in ("mu", "ta", "ri", "so") for b in ("la", "no", "pe", "du", "kim")]
    texts, grades = [], []
    for _ in range(n):
        grade = int(rng.choice(3, p=[0.8, 0.12, 0.08]))
        body = list(rng.choice(common, 30))
        body[3:3] = [["mild"], ["insulting"], ["hateful", "insulting"]][grade] if grade else []
        texts.append(" ".join(body))
        grades.append(grade)
    return texts, np.array(grades)


def test_grades_are_learned_in_order():
    texts, grades = made(1500)
    model = toxicity.regress([toxicity.words(t) for t in texts], grades, np.bincount(grades, minlength=3).astype(float))
    assert list(model.thresholds) == sorted(model.thresholds)
    new, truth = made(500, seed=1)
    above = model.above(model.score(new))
    severity = above.sum(axis=1)
    assert severity[truth == 0].mean() < severity[truth == 1].mean() < severity[truth == 2].mean()
    assert (model.toxic(new)[1] == (truth > 0)).mean() > 0.99
    assert (0 <= severity).all() and (severity <= 2).all()


def test_words_are_letters_and_stems():
    assert set(toxicity.words("Stupid, STUPID7x").tolist()) == {zlib.crc32(w) for w in (b"stupid", b"stup~", b"x")}
    assert len(toxicity.words(None)) == len(toxicity.words("12 ..")) == 0


@pytest.mark.parametrize("grades", [[], [0, 0, 0], [1, 2]])
def test_one_sided_samples_have_a_model(grades):
    rows = [toxicity.words("a b c")] * len(grades)
    model = toxicity.regress(rows, np.array(grades, dtype=int), np.bincount(np.array(grades, dtype=int), minlength=3).astype(float))
    assert (model.above(model.score(["a b", None]))[:, 0] >= 0.5).tolist() == [bool(grades) and grades[0] > 0] * 2


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (9, None, 1), (3, 1, None), (None, 1, 1), (99, 0, 1)], LABELS)
    assert {(r.id, r.grade) for r in toxicity.graded(labels).collect()} == {(1, 0), (2, 2), (9, 1), (99, 2)}
    model = toxicity.fit(awkward, labels)
    rows = toxicity.grade_texts(awkward, model).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r.expected_severity <= 2 and 0 <= r.p_toxic <= 1 for r in rows)
    kept = toxicity.keep_clean(awkward, model)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(not r.toxic for r in rows)


def test_no_rows(spark, awkward, no_documents):
    none = toxicity.fit(awkward, spark.createDataFrame([], LABELS))
    assert not any(r.toxic for r in toxicity.grade_texts(awkward, none).collect())
    assert toxicity.grade_texts(no_documents, toxicity.fit(no_documents, spark.createDataFrame([(1, 1, 0)], LABELS))).collect() == []


def test_query_on_labelled_documents(spark, sf_dir):
    rows = {r.doc_id: r.toxic for r in QUERIES["op2_toxicity"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic is not null").collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    clean = [rows[r.doc_id] for r in labels if r.toxic == 0]
    assert np.mean(clean) <= 0.05


@pytest.mark.parametrize(("folder", "least"), [("sf0.1", 0.6), ("check_s", 0.95)])
def test_recall_on_labels_that_were_not_fitted(spark, folder, least):
    """The smaller table has about 230 toxic labels to learn from, too few for rarer insults; the larger one 1 000."""
    if not Path(f"/root/testdata/{folder}").exists():
        pytest.skip("no such table")
    docs, labels = (spark.read.parquet(f"/root/testdata/{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter("doc_id % 2 = 0"))
    truth = {r.doc_id: r.toxic for r in labels.filter("doc_id % 2 = 1 and toxic is not null").collect()}
    rows = toxicity.grade_texts(docs.filter("doc_id % 2 = 1"), model).collect()
    found = [(truth[r.doc_id], r.toxic) for r in rows if r.doc_id in truth]
    assert sum(t for t, _ in found) > 50
    assert np.mean([hit for t, hit in found if t]) >= least
    assert np.mean([hit for t, hit in found if not t]) <= 0.01


def test_mostly_toxic_labels_without_a_telling_word_flag_nothing(spark):
    rng = np.random.default_rng(2)
    words = [f"{a}{b}" for a in "bdfgk" for b in ("an", "el", "is", "or")]
    rows = [(i, " ".join(rng.choice(words, 20))) for i in range(400)] + [(400, None), (401, ""), (402, "123")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 > 0)) for i in range(400)], LABELS)
    model = toxicity.fit(docs, labels)
    assert not any(r.toxic for r in toxicity.grade_texts(docs, model).collect())
    assert toxicity.keep_clean(docs, model).count() == 403


def test_an_id_with_many_rows_is_drawn_by_rows(spark, monkeypatch):
    docs = spark.range(20_000).selectExpr("id % 2 as doc_id", "translate(concat('word', id, ' and other'), '0123456789', 'abcdefghij') as text")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1)], LABELS)
    seen = []
    monkeypatch.setattr(toxicity, "regress", lambda rows, grades, shares: seen.append(np.bincount(grades, minlength=3)))
    toxicity.fit(docs, labels, rows_per_grade=50)
    assert (seen[0][:2] > 20).all() and (seen[0] < 100).all()


def test_slopes_against_differences_of_the_likelihood():
    """The fit is a minimum of the penalised likelihood as its definition says: moving any weight or threshold does not lower it."""
    texts, grades = made(300, seed=5)
    rows = [toxicity.words(t) for t in texts]
    shares = np.array([800.0, 120.0, 80.0])
    model = toxicity.regress(rows, grades, shares)
    importance = (shares / np.bincount(grades, minlength=3))[grades]
    importance /= importance.sum()

    def loss(weights, thresholds):
        total = toxicity.PENALTY * np.abs(weights).sum()
        for row, grade, weight in zip(rows, grades, importance):
            score = sum(w for f, w in zip(model.features, weights) if f in row)
            edges = [0.0, *(1 / (1 + np.exp(-(t - score))) for t in thresholds), 1.0]
            total -= weight * np.log(max(edges[grade + 1] - edges[grade], 1e-300))
        return total

    assert len(model.features)
    least = loss(model.weights, model.thresholds)
    for step in (-0.05, 0.05):
        for at in range(len(model.weights)):
            moved = model.weights.copy()
            moved[at] += step
            assert loss(moved, model.thresholds) >= least - 1e-7
        for at in range(2):
            moved = model.thresholds.copy()
            moved[at] += step
            assert loss(model.weights, moved) >= least - 1e-5
