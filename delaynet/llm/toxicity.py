"""Severity grades of toxic text by cumulative-link ordinal regression.

Grades are 0 (not toxic), 1 (toxic) and 2 (toxic and of low quality as well). One
weight vector over the words that a text holds serves all thresholds:
P(grade <= k) = logistic(threshold_k - weights . words), thresholds ascending; stems
of words count as words, so that one weight can serve a family of them. The
expected severity is the sum of P(grade > k), between 0 and the highest grade.

The fit is on a bounded sample of labelled rows, weighted back to the shares that
the grades have among all labels, with an L1 penalty that leaves few words.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.llm.common import hash_order, map_batches, texts_of
from delaynet.session import materialize

GRADES = 3
ROWS_PER_GRADE = 3000  # labelled rows of each grade that are fitted on, about
PENALTY = 5e-5
ROUNDS = 2000
SCREEN = 5.0  # standard errors by which a word's slope must differ from none
STEM = 4
LEAST_PRECISION = 0.9  # of what the fitted sample's decision catches, by weight
MORE_ROWS = 2  # times the wanted rows from which rows are drawn by their words as well
LEAST_ROWS = 8  # rows of the sample that must hold a word

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> np.ndarray:
    """Checksums of the distinct words of a text and of their stems, lower-cased, letters only.

    A stem is the first STEM letters of a longer word, with a mark after them.
    """
    if not text:
        return np.zeros(0, dtype="<u4")
    found = set(_WORD.findall(text.lower()))
    found |= {word[:STEM] + "~" for word in found if len(word) > STEM}
    sums = [zlib.crc32(word.encode("utf-8", "surrogatepass")) for word in found]
    return np.unique(np.array(sums, dtype="<u4"))


@dataclass(frozen=True)
class Model:
    """Weights by word checksum (ascending), and the ascending thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    least: float = 0.5  # P(grade > 0) from which a text counts as toxic

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and each k."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Sums of the weights of the words that each text holds."""
        return np.array([self._weights_of(text).sum() for text in texts], dtype=float)

    def toxic(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Scores, and whether each text counts as toxic.

        That takes a word that tells of toxic text: how many of the labels are toxic says nothing about a single text.
        """
        weights = [self._weights_of(text) for text in texts]
        scores = np.array([found.sum() for found in weights], dtype=float)
        telling = np.array([(found > 0).any() for found in weights], dtype=bool)
        return scores, telling & (self.above(scores)[:, 0] >= self.least)

    def _weights_of(self, text: str | None) -> np.ndarray:
        if not len(self.features):
            return self.weights[:0]
        found = words(text)
        at = np.minimum(np.searchsorted(self.features, found), len(self.features) - 1)
        return self.weights[at[self.features[at] == found]]


def regress(
    rows: list[np.ndarray], grades: np.ndarray, shares: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS
) -> Model:
    """Fit over rows of word checksums; `shares[g]` is the weight of all rows of grade g."""
    present = np.bincount(grades, minlength=GRADES)
    if not present[0] or not present[1:].sum():  # nothing to tell apart
        high = np.full(GRADES - 1, 30.0 if present[0] or not len(grades) else -30.0)
        return Model(np.zeros(0, "<u4"), np.zeros(0), high + np.arange(GRADES - 1))
    lengths = np.array([len(row) for row in rows])
    features, index, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(rows)), lengths)
    common = counts >= LEAST_ROWS
    renumber = np.cumsum(common) - 1
    keep = common[index]
    index, owner, features = renumber[index[keep]], owner[keep], features[common]

    importance = (shares / np.maximum(present, 1))[grades]
    importance = importance / importance.sum()
    below = np.cumsum(np.bincount(grades, weights=importance, minlength=GRADES))[:-1]
    below = np.clip(below, 1e-4, 1 - 1e-4)
    thresholds = np.log(below / (1 - below)) + 1e-3 * np.arange(GRADES - 1)
    def slopes(weights, thresholds, index, owner, size):
        """Gradient over weights and thresholds, and each row's derivative by its score."""
        score = np.bincount(owner, weights=weights[index], minlength=len(rows))
        inner = 1.0 / (1.0 + np.exp(-np.clip(thresholds[None, :] - score[:, None], -500, 500)))
        edges = np.c_[np.zeros(len(rows)), inner, np.ones(len(rows))]
        slope, row = edges * (1 - edges), np.arange(len(rows))
        chance = np.maximum(edges[row, grades + 1] - edges[row, grades], 1e-12)
        by_score = importance * (slope[row, grades + 1] - slope[row, grades]) / chance
        by_threshold = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            at, after = grades == k, grades == k + 1
            by_threshold[k] = (importance[after] * slope[after, k + 1] / chance[after]).sum()
            by_threshold[k] -= (importance[at] * slope[at, k + 1] / chance[at]).sum()
        return np.bincount(index, weights=by_score[owner], minlength=size), by_threshold, by_score

    # Words whose slope without any weights is within chance cannot be told from noise.
    slope, _, by_score = slopes(np.zeros(len(features)), thresholds, index, owner, len(features))
    noise = np.sqrt(np.bincount(index, minlength=len(features)) * np.mean(by_score**2))
    telling = np.abs(slope) > SCREEN * noise
    renumber = np.cumsum(telling) - 1
    keep = telling[index]
    index, owner, features = renumber[index[keep]], owner[keep], features[telling]
    if not len(features):
        return Model(features, np.zeros(0), thresholds)

    vector = np.ones(len(features))  # largest curvature, by power iteration
    for _ in range(30):
        spread = importance * np.bincount(owner, weights=vector[index], minlength=len(rows))
        vector = np.bincount(index, weights=spread[owner], minlength=len(features))
        largest = float(np.linalg.norm(vector))
        vector /= largest
    pace = 1.0 / (largest + 1.0)
    weights, ahead, inertia = np.zeros(len(features)), np.zeros(len(features)), 1.0
    base = base_ahead = thresholds
    for _ in range(rounds):
        slope, by_threshold, _ = slopes(ahead, base_ahead, index, owner, len(features))
        moved = ahead - pace * slope
        moved = np.sign(moved) * np.maximum(np.abs(moved) - pace * penalty, 0.0)
        shifted = np.sort(base_ahead - pace * by_threshold)
        faster = (1 + np.sqrt(1 + 4 * inertia**2)) / 2
        ahead = moved + (inertia - 1) / faster * (moved - weights)
        base_ahead = np.sort(shifted + (inertia - 1) / faster * (shifted - base))
        weights, base, inertia = moved, shifted, faster
    used = weights != 0
    score = np.bincount(owner, weights=weights[index], minlength=len(rows))
    return Model(features[used], weights[used], base, _decision(score - base[0], grades > 0, importance))


def _decision(margin: np.ndarray, toxic: np.ndarray, importance: np.ndarray) -> float:
    """The probability between two neighbouring rows that gives the best F1 on the weighted sample.

    Cuts below LEAST_PRECISION do not count; without any other, one half.
    """
    order = np.argsort(-margin, kind="stable")
    margin, hit, all_above = margin[order], np.cumsum(importance[order] * toxic[order]), np.cumsum(importance[order])
    f1 = np.where(hit >= LEAST_PRECISION * all_above, 2 * hit / (all_above + hit[-1]), -1.0)
    f1[:-1][margin[:-1] == margin[1:]] = -1.0  # equal rows stay together
    at = int(f1.argmax())
    if f1[at] < 0:
        return 0.5
    border = (margin[at] + margin[min(at + 1, len(margin) - 1)]) / 2
    return float(1.0 / (1.0 + np.exp(-np.clip(border, -500, 500))))


def graded(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """`id, grade` of labelled documents; the highest grade of labels that repeat an id."""
    grade = F.when(F.col("toxic") == 0, 0).when((F.col("toxic") == 1) & (F.col("quality") == 0), 2).when(F.col("toxic") == 1, 1)
    rows = labels.select(F.col(doc_id).cast("bigint").alias("id"), grade.alias("grade"))
    return rows.filter("id is not null and grade is not null").groupBy("id").agg(F.max("grade").alias("grade"))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_per_grade: int = ROWS_PER_GRADE
) -> Model:
    """Fit on about `rows_per_grade` labelled rows of each grade, drawn by a fixed hash of the id.

    The drawn ids are few by that bound and go to the documents; only checksums
    of the sample's words come back to the driver. Rows of one id that hold the same words
    are one, and if ids with many rows bring more rows than wanted, these are drawn
    again by their words. Null ids, labels without a match and null grades are left out,
    and with one grade or none the model has no words.
    """
    known = graded(labels, doc_id)
    counts = {row.grade: row["count"] for row in known.groupBy("grade").count().collect()}
    shares = np.array([counts.get(grade, 0) for grade in range(GRADES)], dtype=float)
    drawn = known.filter(F.pmod(hash_order("id"), F.lit(_DRAWS)) < _rate(counts, rows_per_grade))

    def run(batches):
        for batch in batches:
            found = [words(content).tobytes() for content in texts_of(batch)]
            columns = [batch.column("id"), batch.column("grade"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "grade", "words"])

    sample = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).join(F.broadcast(drawn), "id")
    held = materialize(map_batches(sample.select("id", "grade", "text"), run, "id bigint, grade int, words binary").distinct(), "labelled")
    sizes = {row.grade: row["count"] for row in held.groupBy("grade").count().collect()}
    many = {grade: n for grade, n in sizes.items() if n > MORE_ROWS * rows_per_grade}
    again = F.pmod(F.xxhash64("id", "words"), F.lit(_DRAWS)) < _rate(many, rows_per_grade, _DRAWS)
    rows = sorted(held.filter(again).collect(), key=lambda row: (row.id, bytes(row.words)))
    features = [np.frombuffer(row.words, dtype="<u4") for row in rows]
    return regress(features, np.array([row.grade for row in rows], dtype=np.int64), shares)


_DRAWS = 1_000_000


def _rate(counts: dict[int, int], wanted: int, other: int = 0) -> Column:
    """The share of _DRAWS that brings `wanted` rows of each counted grade."""
    rate = F.lit(other)
    for grade, n in counts.items():
        rate = F.when(F.col("grade") == grade, min(_DRAWS, -(-_DRAWS * wanted // n))).otherwise(rate)
    return rate


def grade_texts(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, expected_severity, p_toxic, severity, toxic` of every row's whole text.

    `severity` is the most likely grade, the lower of equals. `toxic` holds from the
    probability of any toxic grade on that served the fitted sample best, and only for texts
    with a word that tells of toxic text. A null or empty text holds no words: it is graded
    by the thresholds alone and never toxic. Rows that repeat an id or a text each give a
    row, texts of any length are read whole, and no documents give no rows. Other columns
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores, toxic = shared.value.toxic(texts_of(batch))
            above = shared.value.above(scores)
            likely = -np.diff(np.c_[np.ones(len(above)), above, np.zeros(len(above))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(above[:, 0]),
                    pa.array(likely.argmax(axis=1).astype(np.int32)), pa.array(toxic),
                ],
                names=["doc_id", "expected_severity", "p_toxic", "severity", "toxic"],
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, run, "doc_id bigint, expected_severity double, p_toxic double, severity int, toxic boolean")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that are not graded toxic; a model without words keeps all."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            _, toxic = shared.value.toxic(batch.column(at).to_pylist())
            yield batch.filter(pa.array(~toxic))

    return map_batches(docs, run, docs.schema)
