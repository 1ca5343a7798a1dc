import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from delaynet.operators import graph, similarity
from delaynet.session import materialize


def make_bags(seed=5):
    """Random sets, two families of exact copies, and a token almost everybody has."""
    rng = random.Random(seed)
    bags = {}
    for i in range(60):
        base = {f"t{rng.randrange(40):02}" for _ in range(rng.randrange(1, 14))}
        bags[f"g{i:03}"] = base | ({"common"} if rng.random() < 0.9 else set())
    for i in range(30):
        bags[f"copy{i:02}"] = {"t01", "t02", "t03", "common"}
    for i in range(5):
        bags[f"near{i}"] = {"t01", "t02", "t03", "common", f"x{i}"}
    return bags


def distance(a, b):
    return 1.0 - len(a & b) / (len(a) + len(b) - len(a & b))


def frames(spark, bags):
    rows = spark.createDataFrame([(g, t) for g, ts in bags.items() for t in sorted(ts) * 2], "g string, t string")
    bag_rows = materialize(similarity.token_bags(rows, F.col("g"), F.col("t")), "bags")
    return bag_rows, materialize(similarity.minhash_signatures(similarity.profiles(bag_rows)), "signatures")


@pytest.fixture(scope="module")
def data(spark):
    bags = make_bags()
    return bags, *frames(spark, bags)


def opened(pairs, bags):
    """Group pairs that profile pairs stand for."""
    families = {}
    for group, tokens in sorted(bags.items()):
        families.setdefault(frozenset(tokens), []).append(group)
    members = {groups[0]: groups for groups in families.values()}
    found = {}
    for row in pairs:
        left, right = members[row.profile_a], members[row.profile_b]
        assert (row.members_a, row.members_b) == (len(left), len(right))
        if row.profile_a == row.profile_b:
            both = combinations(left, 2)
        else:
            both = ((x, y) for x in left for y in right)
        for x, y in both:
            key = (min(x, y), max(x, y))
            assert key not in found
            found[key] = row.jaccard_distance
    return found


@pytest.mark.parametrize("threshold", [0.2, 0.3, 0.5, 0.85])
@pytest.mark.parametrize("block", [3, 250])
def test_exact_pairs_match_brute_force(data, threshold, block, monkeypatch):
    bags, _, signatures = data
    monkeypatch.setattr(similarity._paired, "__defaults__", (block,))
    found = opened(similarity.exact_pairs(signatures, threshold).collect(), bags)
    want = {(a, b): distance(bags[a], bags[b]) for a, b in combinations(sorted(bags), 2) if distance(bags[a], bags[b]) < threshold}
    assert found.keys() == want.keys()
    assert all(abs(found[key] - want[key]) < 1e-12 for key in want)


def agreeing(signatures, tables=3):
    return {r.profile: [r[f"h{i}"] for i in range(tables)] for r in signatures.collect()}


@pytest.mark.parametrize("threshold", [0.3, 0.85])
@pytest.mark.parametrize("max_bucket", [2, 1000])
def test_lsh_pairs_match_brute_force(data, threshold, max_bucket):
    bags, bag_rows, signatures = data
    found = opened(similarity.lsh_pairs(signatures, threshold, max_bucket=max_bucket).collect(), bags)
    hashes = {r.group_id: [r.h0, r.h1, r.h2] for r in similarity.minhash_signatures(bag_rows).collect()}
    want = {
        (a, b) for a, b in combinations(sorted(bags), 2)
        if distance(bags[a], bags[b]) < threshold and any(x == y for x, y in zip(hashes[a], hashes[b]))
    }
    assert found.keys() == want


@pytest.mark.parametrize("k", [1, 7, 40, 400])
@pytest.mark.parametrize("directed", [False, True])
def test_top_pairs_match_brute_force(data, k, directed):
    bags, bag_rows, signatures = data
    want = [
        (round(distance(bags[a], bags[b]), 3), *order)
        for a, b in combinations(sorted(bags), 2) if distance(bags[a], bags[b]) < 0.5
        for order in ([(a, b), (b, a)] if directed else [(a, b)])
    ]
    got = similarity.top_pairs(similarity.exact_pairs(signatures, 0.5), bag_rows, k, digits=3, directed=directed)
    assert [(r.jaccard_distance, r.group_a, r.group_b) for r in got.collect()] == sorted(want)[:k]


@pytest.mark.parametrize("k", [1, 7, 40, 4000])
def test_closest_pairs_stop_early_without_a_difference(data, k):
    _, bag_rows, signatures = data
    asked = []

    def below(limit):
        asked.append(limit)
        return similarity.exact_pairs(signatures, limit)

    got = similarity.closest_pairs(below, bag_rows, k, 0.8, digits=3, directed=True).collect()
    whole = similarity.top_pairs(similarity.exact_pairs(signatures, 0.8), bag_rows, k, digits=3, directed=True).collect()
    assert got == whole
    assert asked == sorted(asked) and (asked[-1] == 0.8 or len(got) == k)


def test_quality_counts(data):
    bags, bag_rows, signatures = data
    pairs = similarity.exact_pairs(signatures, 0.5, "h0", "h1", "h2")
    hashes = {r.group_id: [r.h0, r.h1, r.h2] for r in similarity.minhash_signatures(bag_rows).collect()}
    for row in similarity.lsh_quality(signatures, pairs).collect():
        met = [(a, b) for a, b in combinations(sorted(bags), 2) if any(hashes[a][i] == hashes[b][i] for i in range(row.tables))]
        close = {(a, b) for a, b in combinations(sorted(bags), 2) if distance(bags[a], bags[b]) < 0.5}
        assert (row.candidates, row.true_pairs, row.hits) == (len(met), len(close), len(close & set(met)))


def by_tables(rows):
    return {row.tables: row for row in rows.collect()}


def test_quality_of_a_whole_sample_is_exact(data):
    _, _, signatures = data
    whole = by_tables(similarity.lsh_quality(signatures, similarity.exact_pairs(signatures, 0.5, "h0", "h1", "h2")))
    for tables, row in by_tables(similarity.sampled_quality(signatures, 0.5, per_stratum=1000)).items():
        full = whole[tables]
        assert row.sampled == row.profiles == signatures.count()
        assert (row.candidates, row.true_pairs, row.hits) == (full.candidates, full.true_pairs, full.hits)
        assert row.recall_low == row.recall == row.recall_high == full.recall


def test_intervals_of_samples_cover_the_full_recall(spark):
    rng = random.Random(11)
    bags = {}
    for family in range(60):
        base = [f"f{family}t{j}" for j in range(rng.randrange(6, 20))]
        for i in range(rng.randrange(1, 9)):
            own = rng.sample(base, len(base) - rng.randrange(0, 3))
            for copy in range(rng.choice([1, 1, 3])):
                bags[f"g{family:02}-{i}-{copy}"] = set(own)
    _, signatures = frames(spark, bags)
    full = by_tables(similarity.lsh_quality(signatures, similarity.exact_pairs(signatures, 0.4, "h0", "h1", "h2")))
    covered, drawn = 0, 12
    for seed in range(drawn):
        for tables, row in by_tables(similarity.sampled_quality(signatures, 0.4, per_stratum=25, seed=seed)).items():
            assert row.sampled < row.profiles and row.recall_low < row.recall_high
            covered += row.recall_low <= full[tables].recall <= row.recall_high
    assert covered >= 0.8 * 3 * drawn


def test_sampled_search_makes_no_list_of_all_pairs(spark):
    """Near-equal sets: the search makes the sample's pairs, not those of all profiles."""
    n, shared = 500, [f"s{i:02}" for i in range(20)]
    _, signatures = frames(spark, {f"g{i:04}": {*shared, f"own{i}"} for i in range(n)})
    sample = materialize(similarity.stratified_sample(signatures, 10), "sample")
    assert sample.count() == 10
    partners = {(row.tables, row.partners) for row in similarity.sampled_partners(signatures, sample, 0.3).collect()}
    assert partners == {(tables, n - 1) for tables in (1, 2, 3)}


def test_sampled_quality_of_nothing_and_of_sets_without_partners(spark):
    _, signatures = frames(spark, {"a": {"x"}, "b": {"y"}})
    assert {(r.true_pairs, r.recall, r.recall_low) for r in similarity.sampled_quality(signatures, 0.3, method="md5").collect()} <= {(0.0, None, None)}
    assert similarity.sampled_quality(signatures.limit(0), 0.3).count() == 0
    with pytest.raises(ValueError):
        similarity.sampled_quality(signatures, 0.3, per_stratum=1)


def test_fingerprints_keep_token_boundaries(spark):
    _, signatures = frames(spark, {"a": {"x,1:y"}, "b": {"x", "y"}, "c": {"x,y"}})
    assert signatures.count() == 3


def test_clusters_cover_all_groups(data):
    bags, bag_rows, signatures = data
    pairs = similarity.exact_pairs(signatures, 0.3)
    found = similarity.clusters(bag_rows, signatures, graph.connected_components(similarity.cluster_edges(pairs))).collect()
    assert sorted(r.group_id for r in found) == sorted(bags)
    label = {r.group_id: r.cluster_id for r in found}
    for a, b in combinations(sorted(bags), 2):
        if distance(bags[a], bags[b]) < 0.3:
            assert label[a] == label[b]


def reachable(bags, threshold):
    """Smallest group that pairs closer than the threshold lead to, by following them."""
    label = {group: group for group in bags}
    changed = True
    while changed:
        changed = False
        for a, b in combinations(sorted(bags), 2):
            if label[a] != label[b] and distance(bags[a], bags[b]) < threshold:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


@pytest.mark.parametrize("seed, threshold", [(5, 0.3), (6, 0.55)])
def test_clusters_without_pairs_are_those_of_all_pairs(spark, seed, threshold):
    bags = make_bags(seed)
    bag_rows, signatures = frames(spark, bags)
    found = similarity.clusters(bag_rows, signatures, similarity.cluster_components(signatures, threshold)).collect()
    assert {r.group_id: r.cluster_id for r in found} == reachable(bags, threshold)


def test_chains_that_no_representative_sees_whole_are_joined(spark, monkeypatch):
    """Windows over one row of tokens: each is near its neighbours only, and all share crowded tokens."""
    bags = {f"w{i:02}": {f"t{j:02}" for j in range(i, i + 12)} for i in range(0, 40, 2)} | {"far": {"t00", "z1", "z2", "z3"}}
    bag_rows, signatures = frames(spark, bags)
    keyed = similarity._keyed(signatures, 0.35)
    alone = keyed.withColumn("component_id", F.col("profile"))
    pairs = {tuple(r) for r in similarity.cross_links(alone, 0.35, block=3).collect()}
    assert pairs == {(a, b) for a, b in combinations(sorted(bags), 2) if distance(bags[a], bags[b]) < 0.35}
    found = similarity.cluster_components(signatures, 0.35).collect()
    assert {r.profile: r.component_id for r in found} == reachable(bags, 0.35)


def test_near_equal_sets_cost_links_in_proportion(spark):
    n, shared = 600, [f"s{i:02}" for i in range(30)]
    bag_rows, signatures = frames(spark, {f"g{i:04}": {*shared, f"own{i}"} for i in range(n)})
    keyed = materialize(similarity._keyed(signatures, 0.3), "keyed")
    stars = similarity.star_links(keyed, 0.3)
    assert n - 1 <= stars.count() <= keyed.count() <= 15 * n
    labelled = keyed.withColumn("component_id", F.lit("g0000"))
    plan = similarity.cross_links(labelled, 0.3)
    assert plan.isEmpty()
    found = similarity.cluster_components(signatures, 0.3)
    assert {r.component_id for r in found.collect()} == {"g0000"} and found.count() == n


def test_null_tokens_are_dropped(spark):
    rows = spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "g string, t string")
    assert [tuple(r) for r in similarity.token_bags(rows, F.col("g"), F.col("t")).collect()] == [("a", ["x"])]
