import random

import pytest
from pyspark.sql import functions as F

from delaynet.operators import graph


def edges(spark, rows):
    return spark.createDataFrame(rows, "origin string, destination string, weight long")


def expected_ranks(rows, iterations=10, weighted=False):
    ids = sorted({v for a, b, _ in rows for v in (a, b)})
    total = {}
    for a, _, w in rows:
        total[a] = total.get(a, 0) + (w if weighted else 1)
    rank = dict.fromkeys(ids, 1.0)
    for _ in range(iterations):
        received = dict.fromkeys(ids, 0.0)
        for a, b, w in rows:
            if total[a]:
                received[b] += rank[a] * (w if weighted else 1) / total[a]
        rank = {v: 0.15 + 0.85 * received[v] for v in ids}
    scale = len(ids) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


def random_rows(seed=1, n=30, m=120):
    rng = random.Random(seed)
    pairs = {(f"v{rng.randrange(n):02}", f"v{rng.randrange(n):02}") for _ in range(m)}
    # one hub receives from and sends to a large share of all vertices
    pairs |= {("hub", f"v{i:02}") for i in range(n)} | {(f"v{i:02}", "hub") for i in range(0, n, 2)} | {("v00", "sink")}
    return [(a, b, rng.randrange(10)) for a, b in sorted(pairs)]


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("per_salt", [1_000_000, 4])
def test_pagerank(spark, weighted, per_salt):
    rows = random_rows()
    weight = F.col("weight") if weighted else None
    got = {r.airport: r.pagerank for r in graph.pagerank(edges(spark, rows), weight=weight, per_salt=per_salt).collect()}
    want = expected_ranks(rows, weighted=weighted)
    assert got.keys() == want.keys()
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)
    assert abs(sum(got.values()) - len(got)) < 1e-9


def test_pagerank_rounds_and_writes(spark):
    rows = random_rows(2, 8, 20)
    for iterations, write_every in ((1, 5), (4, 3)):
        ranks = graph.pagerank(edges(spark, rows), iterations, write_every=write_every).collect()
        want = expected_ranks(rows, iterations)
        assert all(abs(r.pagerank - want[r.airport]) < 1e-9 for r in ranks)


@pytest.mark.parametrize("per_salt", [1_000_000, 2])
def test_components(spark, per_salt):
    path = [(f"p{i:02}", f"p{i + 1:02}", 1) for i in range(60)]
    random.Random(3).shuffle(path)
    rows = path + [("x", "y", 1), ("z", "y", 1), ("loop", "loop", 1), ("b", "a", 1)]
    got = {r.airport: r.component_id for r in graph.connected_components(edges(spark, rows), per_salt).collect()}
    assert {got[f"p{i:02}"] for i in range(61)} == {"p00"}
    assert (got["x"], got["y"], got["z"], got["loop"], got["a"], got["b"]) == ("x", "x", "x", "loop", "a", "a")
    sizes = graph.component_sizes(spark.createDataFrame(list(got.items()), "airport string, component_id string"))
    assert {r.component_id: r.size for r in sizes.collect()} == {"p00": 61, "x": 3, "loop": 1, "a": 2}


def test_empty_graph_gives_empty_tables(spark):
    nothing = edges(spark, [])
    assert graph.pagerank(nothing).collect() == []
    assert graph.connected_components(nothing).collect() == []
    assert graph.pagerank(nothing).columns == ["airport", "pagerank"]
    assert tuple(graph.graph_stats(nothing).first()) == (0, 0)


def test_top_hubs_breaks_ties_by_name(spark):
    ranks = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "airport string, pagerank double")
    assert [r.airport for r in graph.top_hubs(ranks, 2).collect()] == ["c", "a"]
