import numpy as np
import pytest

from delaynet.llm import vantage
from delaynet.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, size int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 99, 99) for i, v in rows], SCHEMA).repartition(3)


def reference(rows, k, every=20):
    """By brute force, in double precision on the stored components."""
    real = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        real[i, tuple(np.float32(v).astype(float))] = None
    out = {}
    for q, x in real:
        if q % every == 0:
            found = [(-float((np.array(x) * np.array(y)).sum()), i) for i, y in real if i != q and len(y) == len(x)]
            out.setdefault(q, []).extend(found)
    return {q: sorted(found)[:k] for q, found in out.items()}


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    assert all([rank for rank, *_ in found] == list(range(1, len(found) + 1)) for found in out.values())
    return {q: [(s, i) for _, s, i in found] for q, found in out.items()}


def same(found, expected):
    assert {q for q, e in expected.items() if e} == set(found)
    for q in found:
        assert [i for _, i in found[q]] == [i for _, i in expected[q]]
        assert np.allclose([s for s, _ in found[q]], [s for s, _ in expected[q]], rtol=0, atol=1e-12)


@pytest.mark.parametrize("scaled", [False, True])
def test_factor_one_is_exact(spark, scaled, monkeypatch):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(900, 8)) * (rng.uniform(0.1, 3, (900, 1)) if scaled else 1)
    vectors[100:160] = vectors[100]  # ties
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    found = answers(vantage.nearest(frame(spark, rows), k=15, factor=1.0, shard_rows=300, block_rows=20))
    same(found, reference(rows, 15))


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(20, 4)) * 10
    vectors = np.repeat(middles, 300, axis=0) + rng.normal(size=(6000, 4)) * 0.05
    top = np.sqrt((vectors**2).sum(axis=1).max()) * (1 + 1e-12)
    ids = np.arange(6000)
    asked = ids[::50]
    products = vectors[asked] @ vectors.T
    products[np.arange(len(asked)), asked] = -np.inf
    expected = np.argsort(-products, axis=1, kind="stable")[:, :10]
    work = []
    for factor in (1.0, 1.5):
        search = vantage.Search(vantage.build(ids, vectors, top), asked, vectors[asked], np.full(len(asked), -np.inf), 10, factor, top)
        search.run()
        work.append(search.visited)
        recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(search.found.tolist(), expected.tolist())])
        assert recall == 1.0 if factor == 1.0 else recall > 0.8
    assert work[1] < work[0] < products.size


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [0.5, 0.5]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [1.0, inf]), (140, [None, 1.0]),
        (None, [1.0, 1.0]), (1, [2.0, 2.0]), (1, [2.0, 2.0]), (2, [2.0, 2.0]), (3, [-1.0, -1.0]), (160, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 2.0]),
        (180, [1.0]), (-20, [0.25, 1.0]),
    ]
    found = answers(vantage.nearest(frame(spark, rows), k=3, factor=1.0))
    same(found, reference(rows, 3))
    assert 180 not in found and {i for _, i in found[160]} == {4}


def test_one_id_with_a_third_of_all_rows(spark):
    """Its repeats fold and its other vectors spread over shards; answers stay those of brute force."""
    rng = np.random.default_rng(4)
    vectors = [[float(np.float32(x)) for x in v] for v in rng.normal(size=(1200, 5))]
    rows = [(i, v) for i, v in enumerate(vectors[:600])] + [(7, v) for v in vectors[600:900]] + [(40, v) for v in vectors[900:1000]] + [(7, vectors[7])] * 500
    found = answers(vantage.nearest(frame(spark, rows), k=6, factor=1.0, shard_rows=100, block_rows=10))
    same(found, reference(rows, 6))
    once = vantage.without_repeats(vantage.usable(frame(spark, rows)))
    assert once.count() == len({(i, tuple(v)) for i, v in rows})


def test_no_vectors(spark):
    assert vantage.nearest(frame(spark, [])).collect() == []
    assert vantage.nearest(frame(spark, [(1, [1.0]), (2, [2.0])])).collect() == []


def test_query_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = reference(rows, 20)
    found = answers(QUERIES["op3_vantage_point_search"](spark, sf_dir))
    assert set(found) == set(expected)
    recall = [len({i for _, i in found[q]} & {i for _, i in e}) / len(e) for q, e in expected.items()]
    assert np.mean(recall) >= 0.9
