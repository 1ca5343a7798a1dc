import tracemalloc

import numpy as np
import pytest
import xxhash

from delaynet.llm import simhash
from delaynet.llm.queries import QUERIES


def reference_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def reference_components(fps, distance=3):
    """Root (smallest fingerprint) of each distinct fingerprint, by all pairs."""
    fps = sorted(set(fps))
    root = {fp: fp for fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {fp: find(fp) for fp in fps}


def crowd(n, seed=1, far=6):
    """Fingerprints in a few crowded places and some anywhere."""
    rng = np.random.default_rng(seed)
    out = set(rng.integers(0, 2**63, n // 4, dtype=np.uint64).tolist())
    while len(out) < n:
        fp = int(rng.choice([2**63 + 12345, 99]))
        for bit in rng.integers(0, 64, rng.integers(0, far)):
            fp ^= 1 << int(bit)
        out.add(fp)
    return np.array(sorted(out), dtype=np.uint64)


@pytest.mark.parametrize("text", ["", " \t\n", None, "one", "one two", "A b C", "a b c d e f g", "ÄÖ ü\x0bx\x0cy é", "x " * 300])
def test_fingerprint(text):
    assert int(simhash.majority([simhash.shingle_hashes(text)], step=7)[0]) == reference_fingerprint(text)


def test_gray_neighbours_differ_in_one_bit():
    fp = np.arange(256, dtype=np.uint64)
    ordered = fp[np.argsort(simhash.gray_rank(fp))]
    assert set(np.bitwise_count(ordered[1:] ^ ordered[:-1]).tolist()) == {1}


@pytest.mark.parametrize("distance", [0, 1, 3, 5])
def test_index_finds_all_pairs(distance):
    fp = crowd(700)
    fp = fp[np.argsort(simhash.gray_rank(fp))]
    a, b = fp[:400], fp[400:]
    found = {(i, j) for x, y in simhash.Index(a).links(simhash.Index(b), distance) for i, j in zip(x.tolist(), y.tolist())}
    assert found == set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= distance))))
    whole = simhash.Index(fp)
    alone = [(i, j) for x, y in whole.links(whole, distance) for i, j in zip(x.tolist(), y.tolist())]
    assert len(alone) == len(set(alone))
    assert set(alone) == {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= distance)) if i < j}


@pytest.mark.parametrize("count", [1, 1000, 10**6, 10**9, 10**12])
def test_choices_of_blocks_miss_no_pair(count):
    masks = simhash.blocks_for(count)
    rng = np.random.default_rng(0)
    for _ in range(200):
        differing = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(mask & differing == 0 for mask in masks)
    assert min(m.bit_count() for m in masks) >= min(32, np.log2(max(2, count) / simhash.BUCKET)) - 1


@pytest.mark.parametrize("chunk", [16, 64, 2048])
def test_links_connect_across_chunks_and_partitions(spark, monkeypatch, chunk):
    fp = crowd(900, far=5)
    expected = reference_components(fp.tolist())
    rows = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint").repartition(3)
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    search = simhash._search(3)
    namespace = search.__globals__
    assert namespace["CHUNK"] == chunk

    def sized(batches):
        simhash.CHUNK = chunk  # in the worker
        yield from search(batches)

    monkeypatch.setattr(simhash, "_search", lambda distance: sized)
    links = simhash.links_between(rows, len(fp)).collect()
    root = {int(x): int(x) for x in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        a, b = r.a % 2**64, r.b % 2**64
        assert (a ^ b).bit_count() < 64 and a in root and b in root
        low, high = sorted((find(a), find(b)))
        root[high] = low
    assert {x: find(x) for x in root} == expected
    if chunk == 2048:
        assert len(links) < 4 * len(fp)  # a forest per bucket, not all pairs


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}


def expected_rows(rows):
    fps = {(i, t): reference_fingerprint(t) for i, t in rows}
    root = reference_components(fps.values())
    least = {}
    for (i, _), fp in fps.items():
        if i is not None:
            least[root[fp]] = min(i, least.get(root[fp], i))
    return sorted(((i, fps[i, t], least.get(root[fps[i, t]])) for i, t in rows), key=str)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(awkward).collect()]
    assert sorted(found, key=str) == expected_rows(rows)


def test_one_row_of_each_component_stays(awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    kept = kept.collect()
    found = simhash.near_duplicates(awkward).collect()
    root = {r.fp % 2**64: r.root for r in found}
    roots = [root[reference_fingerprint(r.text)] for r in kept]
    assert len(roots) == len(set(roots)) == len(set(root.values()))
    ids = {r.doc_id for r in kept}
    assert {1, 7, 8} & ids >= {1, 7} and 2 not in ids and 11 not in ids and 4 not in ids and 3 in ids
    assert sum(r.doc_id is None for r in kept) == 1 and sum(r.doc_id == 9 for r in kept) == 2


def test_no_documents(no_documents):
    assert simhash.near_duplicates(no_documents).collect() == []
    assert simhash.keep_one(no_documents).collect() == []


def test_query_against_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op7_simhash_groups"](spark, sf_dir).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in found), key=str) == expected_rows(rows)
    assert all(len(r.fingerprint) == 16 and r.fingerprint == r.fingerprint.lower() for r in found)


def test_near_copies_are_linked(spark):
    base = " ".join(f"w{i}" for i in range(3000))
    docs = [(1, base), (2, base + " tail"), (3, base.replace("w77 ", "v77 ")), (4, " ".join(f"u{i}" for i in range(3000)))]
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4}


def test_counting_bits_holds_little_memory():
    hashes = [np.arange(i, i + 50_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(4)]
    tracemalloc.start()
    found = simhash.majority(hashes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    assert found.tolist() == [simhash.majority([h], step=1000)[0] for h in hashes]
