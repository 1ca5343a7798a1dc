"""Physical plans: pruning, pushdown, partial aggregation, no Python, no cross joins."""

import pytest
from pyspark.sql import functions as F

from delaynet.operators import aggregates, bloom, dedup, graph, hll
from delaynet.plans.queries import QUERIES
from delaynet.sources.tables import flights, table
from delaynet.streaming import ingest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# queries that are a single lazy plan, without rounds or written intermediates
LAZY = [
    "scan_parquet", "json_decode", "quarantine", "keyed_messages", "log_metrics", "log_sweeps", "normalize_row", "delay_tokens", "generalize",
    "clean_rows", "hash_sample", "semi_join_ids", "anti_join_seen", "dedup_keep_first", "dedup_audit", "route_edges", "hub_attribution",
    "fairness", "distinct_routes", "top_keys", "hll_vs_exact", "cms_table", "cms_estimate", "token_bags", "minhash_signatures",
    "dp_counts", "dp_epsilon_sweep", "dp_leakage_audit", "k_anonymity", "data_quality", "throughput_windows", "tier_summary", "map_export",
    "hub_scorecard", "exact_jaccard_join", "lsh_similarity_join", "validation_summary", "pagerank",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text, operator


def test_scans_read_needed_columns_only(spark, sf_dir):
    text = plan(aggregates.route_edges(flights(spark, sf_dir, "origin", "destination", "delay_minutes")))
    assert "p_brand" not in text and "l_shipdate" not in text and "l_extendedprice" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double>" in text


def test_filters_reach_the_scan(spark, sf_dir):
    assert "GreaterThan(value,50.0)" in plan(QUERIES["scan_parquet"](spark, sf_dir))


def test_line_columns_need_no_join(spark, sf_dir):
    assert "Join" not in plan(flights(spark, sf_dir, "tail_number", "delay_minutes", "scheduled_departure"))


@pytest.mark.parametrize(
    "build, partial",
    [
        (lambda t: dedup.keep_first(t, ["l_orderkey"]), "partial_min"),
        (lambda t: hll.registers(t, F.col("l_orderkey").cast("string")), "partial_max"),
        (lambda t: bloom.build(t, F.col("l_orderkey").cast("string"), 4096, 3), "partial_bit_or"),
        (lambda t: aggregates.counts_by(t, "l_suppkey"), "partial_count"),
    ],
)
def test_rows_shrink_before_the_shuffle(spark, sf_dir, build, partial):
    assert partial in plan(build(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")))


@pytest.mark.parametrize("per_salt", [1_000_000, 3])
def test_links_stay_in_their_buckets(spark, monkeypatch, per_salt):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(2000)
        edges = ids.select((F.col("id") % 100).cast("string").alias("origin"), (F.col("id") % 33).cast("string").alias("destination"))
        links = graph._links(edges, None, per_salt)
        assert links.salted == (per_salt == 3)
        state = links.vertices.select("id", "fanout", F.lit(1.0).alias("rank"))
        text = plan(links.with_source(state).groupBy("dst").agg(F.sum("rank")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line and "links" in line)
    join = max(i for i, line in enumerate(lines[:scan]) if "Join" in line)
    assert not any("Exchange" in line for line in lines[join:scan])


def test_a_filter_on_decoded_messages_decodes_once(spark, tmp_path):
    spark.createDataFrame([(b"{}", "p")], "value binary, position string").write.parquet(str(tmp_path / "messages"))
    rows = ingest.classified(spark.read.parquet(str(tmp_path / "messages")))
    assert plan(rows.filter("reason is null").select("flight_id", "delay_minutes")).count("from_json") == 1


def test_rounds_look_states_up_instead_of_sorting_links(spark, monkeypatch):
    edges = spark.range(500).selectExpr("cast(id % 50 as string) as origin", "cast(id % 33 as string) as destination")
    few, many = graph._links(edges, None, 1_000_000), graph._links(edges, None, 1_000_000, per_bucket=1)
    assert few.hashed and not many.hashed
    monkeypatch.setattr(graph, "bucketed", lambda df, *rest: df)
    joined = plan(few.with_source(few.vertices.select("id", "fanout", F.lit(1.0).alias("rank"))))
    assert "ShuffledHashJoin" in joined and "SortMergeJoin" not in joined


def test_vertices_and_degrees_take_one_pass_over_the_edges(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(graph, "materialize", lambda df, label: written.setdefault(label, df))
    edges = spark.range(20).selectExpr("cast(id % 5 as string) as origin", "cast(id % 7 as string) as destination")
    graph._links(edges, None, 2)
    assert plan(written["vertices"]).count("Range (") == 1
    got = {r.airport: (r.fanout, r.total) for r in written["vertices"].collect()}
    assert got == {str(i): (2, 4.0) if i < 5 else (1, None) for i in range(7)}


def test_the_words_of_a_filter_share_the_bits_of_an_item(spark):
    items = spark.range(10).selectExpr("cast(id as string) as item")
    built = plan(bloom.build(items, F.col("item"), 4096, 12))
    asked = plan(bloom.might_contain(items, F.col("item"), bloom.build(items, F.col("item"), 4096, 12), 4096, 12))
    assert built.count("shiftleft") == 12 and asked.count("shiftleft") <= 24
