"""Cleaning, deduplication, rankings and audits on small tables."""

import random

from pyspark.sql import functions as F

from delaynet.operators import aggregates, audit, clean, dedup, ranking
from delaynet.sources.tables import table

FLIGHT = "origin string, destination string, delay_minutes int, delay_cause string"


def test_cleaning_keeps_blank_codes(spark):
    rows = spark.createDataFrame([("A", "B", 1, None), ("", "B", 2, "nas"), (None, "B", 3, "nas"), ("A", "B", None, "nas")], FLIGHT)
    assert clean.drop_unrouted(rows).count() == 3
    assert sorted(tuple(r) for r in clean.clean_rows(rows).collect()) == [("", "B", 2, "nas"), ("A", "B", 1, "UNKNOWN")]


def test_samples(spark):
    rows = spark.range(20_000)
    sampled = clean.hash_sample(rows, F.col("id").cast("string"))
    assert abs(sampled.count() - 2000) < 200
    assert sorted(sampled.collect()) == sorted(clean.hash_sample(rows.repartition(7), F.col("id").cast("string")).collect())
    assert clean.uniform_n(rows, 10).distinct().count() == 10
    assert clean.uniform_n(rows, 30_000, F.col("id").cast("string")).count() == 20_000
    assert [r.id for r in clean.first_n(rows, 3, F.desc("id")).collect()] == [19_999, 19_998, 19_997]
    assert abs(clean.bernoulli_sample(rows).count() - 2000) < 200


def test_keep_first_prefers_smallest_row(spark):
    rows = spark.createDataFrame([("k", 2, "x"), ("k", 1, "z"), ("k", 1, "y"), ("n", None, "b"), ("n", 0, "a"), (None, 5, "q")], "k string, a int, b string")
    assert sorted((tuple(r) for r in dedup.keep_first(rows, ["k"]).collect()), key=str) == sorted(
        [("k", 1, "y"), ("n", None, "b"), (None, 5, "q")], key=str
    )
    assert {tuple(r) for r in dedup.keep_first(rows.filter("k = 'k'"), ["k"], ["b"]).collect()} == {("k", 2, "x")}


def test_hot_key_is_one_row(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    assert dedup.keep_first(rows, ["k"]).count() == dedup.dedup_batch(rows, "k").count() == rows.select("k").distinct().count()


def test_membership_and_audit(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "a")], "batch int, id string")
    first = rows.filter("batch = 1")
    assert dedup.accepted_only(rows, first, "id").count() == 5
    assert [r.id for r in dedup.not_seen(rows, first, "id").collect()] == ["c"]
    got = sorted(tuple(r) for r in dedup.batch_audit(rows, F.col("batch"), "id").collect())
    assert got == [(1, 3, 2, 2, 0), (2, 2, 2, 1, 1), (3, 1, 1, 0, 1)]


def scores(spark, names):
    return spark.createDataFrame([(n, float(100 - i)) for i, n in enumerate(names)], "airport string, s double")


def test_rankings(spark):
    ours = ranking.ranked(scores(spark, "abcdefg"), "airport", "s", 20)
    theirs = ranking.ranked(scores(spark, "bacxyzwvut"), "airport", "s", 30)
    table = sorted(tuple(r) for r in ranking.side_by_side(ours, theirs).collect())
    assert table[0] == (1, "a", "b") and table[9] == (10, "N/A", "t") and len(table) == 10
    assert tuple(ranking.precision_at_k(ours, theirs).first()) == (7, 3, 3 / 7 * 100)
    assert tuple(ranking.ranking_overlap(ours, theirs).first()) == (3, 15.0, "differs")
    assert tuple(ranking.ranking_overlap(ours, theirs, 3).first()) == (3, 100.0, "validated")
    curve = sorted(tuple(r) for r in ranking.overlap_curve(ours, theirs, [1, 2, 5, 10]).collect())
    assert curve == [(1, 0, 0.0), (2, 2, 100.0), (5, 3, 60.0)]


def test_empty_ranking_has_no_precision(spark):
    empty = ranking.ranked(spark.createDataFrame([], "airport string, s double"), "airport", "s", 20)
    assert tuple(ranking.precision_at_k(empty, ranking.ranked(scores(spark, "ab"), "airport", "s", 20)).first()) == (0, 0, None)


def test_map_rows(spark):
    ranks = scores(spark, "ab").withColumnRenamed("s", "pagerank")
    components = spark.createDataFrame([("a", "a"), ("b", "a")], "airport string, component_id string")
    places = spark.createDataFrame([("a", 1.0, 2.0)], "airport string, lat double, lng double")
    everything = ranking.attach_coordinates(ranks, components, places)
    assert {(r.airport, r.lat, r.lng) for r in everything.collect()} == {("a", 1.0, 2.0), ("b", 0.0, 0.0)}
    assert [r.airport for r in ranking.mapped_only(everything).collect()] == ["a"]


def test_percentiles_match_sorting(spark):
    rng = random.Random(4)
    rows = [(rng.choice("aab"), round(rng.expovariate(0.05), 2)) for _ in range(2000)] + [("c", 7.0)] + [("d", None)] + [("a", 3.0)] * 900
    table = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {r.g: (r.p1, r.p50, r.p99, r.p100) for r in audit.windowed_percentiles(table, "g", "v", [1, 50, 99, 100]).collect()}
    assert set(got) == {"a", "b", "c"}
    for group, found in got.items():
        values = sorted(v for g, v in rows if g == group and v is not None)
        assert found == tuple(values[max(1, -(-len(values) * p // 100)) - 1] for p in (1, 50, 99, 100))


def test_percentiles_of_a_crowded_window(spark, monkeypatch):
    monkeypatch.setattr(audit, "BINS", 8)
    monkeypatch.setattr(audit, "FEW_VALUES", 16)
    rng = random.Random(3)
    values = [rng.random() * 1e-6 for _ in range(3000)] + [1e9, -1e9] + [0.5] * 40  # nearly all in one bin, of a wide range
    rows = [("hot", v) for v in values] + [("one", 2.0), ("nan", float("nan")), ("nan", float("inf"))]
    table = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {r.g: (r.p1, r.p50, r.p99) for r in audit.windowed_percentiles(table, "g", "v", [1, 50, 99]).collect()}
    values.sort()
    assert got == {"hot": tuple(values[max(1, -(-len(values) * p // 100)) - 1] for p in (1, 50, 99)), "one": (2.0, 2.0, 2.0)}


def test_windows_read_their_rows_once(spark, sf_dir):
    result = audit.throughput_windows(table(spark, sf_dir, "events"), "ts", "value")
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in text and "counted-" in text


def test_quality_profile(spark):
    rows = spark.createDataFrame(
        [("1", "A", "2024-01-01 00:00:00"), ("1", "", "2024-01-02 00:00:00"), (None, "B", None), ("2", None, "2024-01-01 12:00:00")],
        "id string, origin string, t string",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    row = audit.data_quality(rows, "id", "t", ["origin"], F.lit("2024-01-02 00:00:30").cast("timestamp_ntz")).first()
    assert (row.total_rows, row.distinct_keys, row.blank_values, row.freshness_seconds) == (4, 2, 1, 30)
    assert (row.compliance_pct, row.null_density_pct, row.duplicate_pct) == (50.0, 25.0, 50.0)
    assert (row.first_ts, row.last_ts) == ("2024-01-01 00:00:00", "2024-01-02 00:00:00")


def test_top_counts_skip_blanks(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("",), ("",), ("",), (None,), ("b",), ("c",)], "tail string")
    assert [tuple(r) for r in aggregates.top_counts(rows, "tail", 2).collect()] == [("a", 2), ("b", 1)]


def test_edges_and_fairness(spark):
    rows = spark.createDataFrame([("A", "B", 5, "x"), ("A", "B", 7, "x"), ("A", None, 1, "x"), ("B", "A", None, "x")], FLIGHT)
    assert [tuple(r) for r in aggregates.route_edges(rows).collect()] == [("A", "B", 12)]
    carrier = F.when(F.col("delay_minutes") > 5, F.lit("AA")).otherwise(F.lit("ZZ"))
    got = {r.carrier_type: (r.mean_delay_minutes, r.sample_size) for r in aggregates.fairness(rows, carrier).collect()}
    assert got == {"Major/Legacy": (7.0, 1), "Regional/Low-Cost": (3.0, 3)}


def test_scorecard_bands(spark):
    ranks = spark.createDataFrame([("a", 2.0), ("b", 1.8), ("c", 0.2)], "airport string, pagerank double")
    volumes = spark.createDataFrame([("a", 10), ("b", 30)], "airport string, n long")
    got = {r.airport: r for r in audit.hub_scorecard(ranks, volumes).collect()}
    assert [got[x].band for x in "abc"] == ["CRITICAL", "HIGH", "MODERATE"]
    assert abs(got["a"].amplification - 2.0) < 1e-12 and got["c"].amplification is None
