import bisect
import math

import pytest
from pyspark.sql import functions as F

from delaynet.operators import aggregates, audit, bloom, cms, hll, scorecard
from delaynet.plans import queries
from delaynet.session import materialize
from delaynet.sources.tables import table


def keys(spark, start, end):
    return spark.range(start, end).select(F.col("id").cast("string").alias("k"))


def value(df):
    return df.first()[0]


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
@pytest.mark.parametrize("n, p", [(0, 10), (1, 10), (500, 10), (20_000, 10), (20_000, 14)])
def test_hll_accuracy(spark, n, p, method):
    estimate = value(hll.estimate(hll.registers(keys(spark, 0, n), F.col("k"), p, method), p))
    assert abs(estimate - n) <= max(1, 4 * 1.04 / math.sqrt(1 << p) * n)


def test_hll_merge_equals_whole(spark):
    whole = hll.registers(keys(spark, 0, 3000), F.col("k"))
    parts = hll.merge(*[hll.registers(keys(spark, a, b), F.col("k")) for a, b in ((0, 1500), (1000, 2500), (2500, 3000))])
    assert sorted(whole.collect()) == sorted(parts.collect())


def test_hll_per_group_merges_to_whole(spark):
    rows = keys(spark, 0, 3000).withColumn("part", F.length("k"))
    grouped = hll.registers(rows, F.col("k"), by=("part",))
    assert sorted(hll.merge(grouped).collect()) == sorted(hll.registers(rows, F.col("k")).collect())


def test_hll_ignores_nulls_and_copies(spark):
    rows = keys(spark, 0, 100).union(keys(spark, 0, 100)).union(spark.sql("select cast(null as string)"))
    assert value(hll.estimate(hll.registers(rows, F.col("k")))) == value(hll.estimate(hll.registers(keys(spark, 0, 100), F.col("k"))))


def test_hll_checks_precision(spark):
    with pytest.raises(ValueError):
        hll.registers(keys(spark, 0, 1), F.col("k"), 3)


def skewed(spark):
    """Key 0 holds a third of all rows."""
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200).cast("string").alias("k"))


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_cms_never_below_exact(spark, method):
    rows = skewed(spark)
    counts = rows.groupBy("k").count()
    estimates = cms.probe(cms.build(rows, "k", widths=[20, 500], method=method), counts, "k", widths=[20, 500], method=method)
    for row in estimates.join(counts, "k").collect():
        assert row.estimate >= row["count"]


def test_cms_ways_to_build_agree(spark):
    rows = skewed(spark)
    counted = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    half = rows.withColumn("part", F.monotonically_increasing_id() % 2)
    built = [
        cms.build(rows, "k", widths=50), cms.build(rows, "k", widths=50, precount=False), cms.build(counted, "k", "n", widths=50),
        cms.merge(*[cms.build(half.filter(f"part = {i}"), "k", widths=50) for i in (0, 1)]),
    ]
    first = sorted(map(tuple, built[0].collect()))
    assert all(sorted(map(tuple, other.collect())) == first for other in built[1:])


def test_cms_unknown_key_and_bad_input(spark):
    sketch = cms.build(keys(spark, 0, 1), "k", widths=1000)
    assert cms.probe(sketch, keys(spark, 5, 6), "k", widths=1000).first().estimate == 0
    with pytest.raises(ValueError):
        cms.build(keys(spark, 0, 1), "k", widths=0)
    with pytest.raises(Exception, match="non-negative"):
        cms.build(keys(spark, 0, 1).withColumn("w", F.lit(-1)), "k", "w").collect()


@pytest.mark.parametrize("limit", [bloom.BROADCAST_LIMIT_BYTES, 0])
def test_bloom_has_no_false_negatives(spark, monkeypatch, limit):
    monkeypatch.setattr(bloom, "BROADCAST_LIMIT_BYTES", limit)
    m, k = 100_003, 5
    added = bloom.merge(*[bloom.build(keys(spark, a, b), F.col("k"), m, k) for a, b in ((0, 2000), (1500, 4000))])
    judged = bloom.might_contain(keys(spark, 0, 14_000), F.col("k"), added, m, k)
    known = judged.filter(F.col("k").cast("int") < 4000)
    assert known.filter("not maybe_seen").isEmpty()
    false_rate = judged.filter("maybe_seen and cast(k as int) >= 4000").count() / 10_000
    assert false_rate <= 1.3 * bloom.expected_fp_rate(4000, m, k) + 0.002


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
@pytest.mark.parametrize("fp_rate", [0.05, 0.01, 0.001])
def test_bloom_keeps_to_the_wanted_rate(spark, fp_rate, method):
    m, k = bloom.sized(20_000, fp_rate)
    assert m % bloom.BLOCK_BITS == 0 and bloom.expected_fp_rate(20_000, m, k) <= fp_rate
    built = bloom.build(keys(spark, 0, 20_000), F.col("k"), m, k, method)
    judged = bloom.might_contain(keys(spark, 0, 220_000), F.col("k"), built, m, k, method)
    known, strangers = judged.groupBy(F.col("k").cast("int") >= 20_000).agg(F.avg(F.col("maybe_seen").cast("int"))).sort("(CAST(k AS INT) >= 20000)").collect()
    assert known[1] == 1.0
    assert strangers[1] <= 1.15 * fp_rate + 3 * (fp_rate / 200_000) ** 0.5


@pytest.mark.parametrize("limit", [bloom.BROADCAST_LIMIT_BYTES, 0])
def test_bloom_probe_is_one_join(spark, monkeypatch, limit):
    monkeypatch.setattr(bloom, "BROADCAST_LIMIT_BYTES", limit)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m, k = bloom.sized(1000, 0.0001)
        judged = bloom.might_contain(keys(spark, 0, 100), F.col("k"), bloom.build(keys(spark, 0, 1000), F.col("k"), m, k), m, k)
        plan = judged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert k > 7 and plan.count("Join ") + plan.count("Join[") == 1
    assert ("BroadcastHashJoin" in plan) == (limit > 0)


def test_null_items_are_neither_added_nor_found(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    built = bloom.build(rows, F.col("k"), 5120, 4)
    judged = bloom.might_contain(rows, F.col("k"), built, 5120, 4)
    assert {(r.k, r.maybe_seen) for r in judged.collect()} == {("a", True), ("b", True), (None, False)}


def test_bloom_bits_match_positions(spark):
    rows = keys(spark, 0, 700)
    expected = rows.select(F.explode(F.array(*bloom.positions(F.col("k"), 70_000, 3))).alias("bit")).distinct()
    assert sorted(bloom.set_bits(bloom.build(rows, F.col("k"), 70_000, 3)).collect()) == sorted(expected.collect())


def test_empty_bloom_knows_nothing(spark):
    empty = bloom.build(keys(spark, 0, 0), F.col("k"), 1000, 2)
    assert bloom.might_contain(keys(spark, 0, 3), F.col("k"), empty, 1000, 2).filter("maybe_seen").isEmpty()
    with pytest.raises(ValueError):
        bloom.build(keys(spark, 0, 1), F.col("k"), 0, 2)


def test_scorecard_is_measured(spark):
    counts = skewed(spark).groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("k", "key")
    rows = scorecard.sketch_scorecard(counts, keys(spark, 1000, 2000).withColumnRenamed("k", "key"), "key").collect()
    assert {row.sketch: row.bytes for row in rows} == {"hyperloglog": 4096, "count_min": 20_000, "bloom": bloom.sized(counts.count())[0] // 8}
    assert all(90 <= row.accuracy_pct <= 100 for row in rows)


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_bloom_dedup_accepts_nearly_all_new_rows(spark, scale):
    sf = f"/root/testdata/{scale}"
    lines = table(spark, sf, "lineitem").select(queries.line_id().alias("record_id"), "l_returnflag")
    known = lines.filter("l_returnflag <> 'R'").select("record_id").distinct()
    new = lines.filter("l_returnflag = 'R'").select("record_id").distinct().join(known, "record_id", "left_anti").count()
    judged = queries.QUERIES["bloom_dedup"](spark, sf)
    accepted = judged.filter("accepted").count()
    assert new * (1 - queries.FP_RATE) <= accepted <= new


def test_bloom_probe_asks_about_strangers(spark, sf_dir):
    rows = queries.QUERIES["bloom_probe"](spark, sf_dir).collect()
    assert all(r.maybe_seen for r in rows if r.added)
    strangers = [r.maybe_seen for r in rows if not r.added]
    assert len(strangers) >= len(rows) // 2 and sum(strangers) <= 0.05 * len(strangers) + 1


def test_bloom_build_hashes_before_the_shuffle(spark):
    plan = bloom.build(keys(spark, 0, 100), F.col("k"), 1024, 4)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_bit_or" in plan


def test_stored_sketches_answer_any_range(spark):
    rows = spark.range(30_000).selectExpr("id % 10 as span", "nullif(cast(id % 7000 as string), '0') as k", "7 as sketch")
    stored = hll.stored_sketches(rows, F.col("span"), F.col("k"))
    assert stored.columns == ["span", "sketch"] and stored.count() == 10
    for spans, truth in (([0], 700), ([0, 1, 2], 2100), (range(10), 6999)):
        found = value(hll.united(stored.filter(F.col("span").isin(list(spans)))))
        assert abs(found - truth) <= 3 * hll.stored_error() * truth + 1
    assert value(hll.united(stored.filter("span > 100"))) == 0
    nothing = hll.stored_sketches(rows.filter("k is null"), F.col("span"), F.col("k"))
    assert [r.estimate for r in hll.united(nothing, "span").collect()] == [0] * nothing.count()


def test_range_estimates_do_not_read_the_rows(spark):
    stored = materialize(hll.stored_sketches(keys(spark, 0, 1000), F.lit(1), F.col("k")), "sketches")
    plan = hll.united(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "sketches" in plan


def test_quantile_sketches_merge(spark):
    """Heavy ties, a hot window, and values that have no place in the order."""
    day = "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(if(id % 3 = 0, 0, id % 5) as int)) as ts"
    numbers = "case when id % 100 = 1 then null when id % 100 = 2 then double('NaN') when id % 100 = 3 then double('inf') when id % 4 = 0 then 5.0 else id / 7 end as x"
    rows = spark.range(40_000).selectExpr(day, numbers)
    stored = audit.quantile_sketches(rows, "ts", "x")
    whole = {r.span: r for r in audit.sketched_percentiles(stored, (1, 50, 99)).collect()}["all"]
    good = sorted(r.x for r in rows.filter("x is not null and not isnan(x) and x < double('inf')").collect())
    assert whole.records == len(good)
    for p in (1, 50, 99):
        found = whole[f"p{p}"]
        below, upto = bisect.bisect_left(good, found) / len(good), bisect.bisect_right(good, found) / len(good)
        assert below - 2 * audit.RANK_ERROR <= p / 100 <= upto + 2 * audit.RANK_ERROR
    assert audit.sketched_percentiles(stored, (50,), F.col("window_start")).count() == stored.count() == 5
    assert audit.quantile_sketches(rows.limit(0), "ts", "x").count() == 0


@pytest.mark.parametrize("tracked", [16, 200])
def test_heavy_keys_keep_their_promise(spark, tracked):
    """A hot key, a slope of frequent ones and many rare, in states of spans that hold them unevenly."""
    kinds = "case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('k', cast(log2(1 + id % 4001) as int)) when id % 31 = 0 then ' ' else cast(id as string) end"
    rows = spark.range(60_000).selectExpr("id % 7 as span", f"{kinds} as key")
    exact = {r.key: r.n for r in aggregates.counts_by(rows.filter("trim(key) <> ''"), "key").collect()}
    states = materialize(aggregates.top_key_states(rows, F.col("span"), F.col("key"), tracked), "states")
    found = {r.key: r for r in aggregates.heavy_keys(states, tracked).collect()}
    error = aggregates.top_key_error(tracked) * sum(exact.values())
    assert {key for key, n in exact.items() if n > 2 * error} <= set(found)
    assert all(exact[key] <= r.n <= exact[key] + error + 1e-6 for key, r in found.items()) and "hot" in found
    assert states.count() == 7 and len(found) <= tracked
    assert aggregates.heavy_keys(states.limit(0), tracked).count() == 0
