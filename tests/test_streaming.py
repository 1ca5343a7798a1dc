import json
import os
import re
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from delaynet.operators import bloom
from delaynet.plans import streams
from delaynet.sources.messages import file_stream, kafka_options
from delaynet.streaming.bloom_ingest import FilterLog, Growth, _held, accept_new, bloom_writer, start_bloom_ingest
from delaynet.streaming.ingest import read_audit, read_ingested, start_ingest, stream_session


def flight(flight_id, origin="A", **more):
    record = {
        "flight_id": flight_id, "tail_number": "", "flight_number": 1, "origin": origin, "destination": "B",
        "scheduled_departure": "2024-01-01T00:00:00", "delay_minutes": 3, "delay_cause": "nas", **more,
    }
    return json.dumps(record)


def deliver(spark, path, *values, age_days=0):
    before = set(Path(path).glob("*.parquet"))
    rows = [(f"k{i}", None if v is None else bytearray(v.encode())) for i, v in enumerate(values)]
    spark.createDataFrame(rows, "key string, value binary").coalesce(1).write.mode("append").parquet(path)
    for file in set(Path(path).glob("*.parquet")) - before:
        old = time.time() - age_days * 86400
        os.utime(file, (old, old))


@pytest.fixture
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("in", "out", "bad", "audit", "checkpoint", "filters")}


def run(spark, place, horizon="7 days", max_files=1):
    stream = file_stream(stream_session(spark, 2), place["in"], max_files)
    query = start_ingest(stream, place["out"], place["bad"], place["audit"], place["checkpoint"], horizon)
    query.awaitTermination()
    assert dropped_as_late(query) == 0
    return query


def run_bloom(spark, place, growth=Growth(1000, 0.001)):
    stream = file_stream(stream_session(spark, 2), place["in"], 1)
    places = [place[name] for name in ("out", "bad", "audit", "filters", "checkpoint")]
    start_bloom_ingest(stream, *places, growth).awaitTermination()


def dropped_as_late(query):
    reports = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in reports for s in p.get("stateOperators", []))


def ids(spark, place):
    return sorted(r.flight_id for r in read_ingested(spark, place["out"]).collect())


def booked(spark, place):
    rows = read_audit(spark, place["audit"]).orderBy("batch_id").collect()
    assert all(r.messages == r.accepted + r.dupes + r.quarantined + r.unrouted for r in rows)
    return [(r.messages, r.accepted, r.dupes, r.quarantined, r.unrouted) for r in rows]


@pytest.mark.parametrize("horizon", ["7 days", None])
def test_dedup_quarantine_and_restart(spark, place, horizon):
    deliver(spark, place["in"], flight("a"), flight("a"), flight("b"), '{"flight_id":"c"', None)
    deliver(spark, place["in"], flight("b"), flight("c"), flight("c", origin=None), '{"origin":"A"}', '{"flight_id":"c"')
    run(spark, place, horizon)
    assert ids(spark, place) == ["a", "b", "c"]
    assert sorted(booked(spark, place)) == [(5, 1, 1, 2, 1), (5, 2, 1, 2, 0)]
    reasons = sorted(r.reason for r in read_ingested(spark, place["bad"]).collect())
    assert reasons == ["unreadable"] * 4 + ["unrouted"]

    # a restart continues with the ids it has seen, and the audit goes on
    deliver(spark, place["in"], flight("a"), flight("d"), flight("e", origin=""))
    run(spark, place, horizon)
    assert ids(spark, place) == ["a", "b", "c", "d", "e"]
    assert booked(spark, place)[-1] == (3, 2, 1, 0, 0) and len(booked(spark, place)) == 3


@pytest.mark.parametrize("horizon", ["1 hour", None])
def test_old_files_are_first_deliveries_like_any_other(spark, place, horizon):
    deliver(spark, place["in"], flight("now"))
    run(spark, place, horizon)
    deliver(spark, place["in"], flight("old"), flight("now"), age_days=30)
    deliver(spark, place["in"], flight("newer"))
    run(spark, place, horizon)
    assert ids(spark, place) == ["newer", "now", "old"]
    assert sum(row[2] for row in booked(spark, place)) == 1


@pytest.mark.parametrize("path", ["exact", "bloom"])
def test_an_unrouted_delivery_does_not_stand_in_the_way(spark, place, path):
    go = run if path == "exact" else run_bloom
    deliver(spark, place["in"], flight("x", origin=None), flight("y"), "junk", '{"flight_id":"z"')
    go(spark, place)
    deliver(spark, place["in"], flight("x"), flight("y", origin=None), flight("z"))
    go(spark, place)
    assert ids(spark, place) == ["x", "y", "z"]
    assert booked(spark, place) == [(4, 1, 0, 2, 1), (3, 2, 0, 0, 1)]
    unreadable = read_ingested(spark, place["bad"]).filter("reason = 'unreadable'").collect()
    assert {r.raw for r in unreadable} == {"junk", '{"flight_id":"z"'}
    assert read_ingested(spark, place["bad"]).count() == 4


def test_wrong_types_become_null_not_failure(spark, place):
    deliver(spark, place["in"], flight("a", delay_minutes="many"), flight("b"))
    run(spark, place)
    kept = ids(spark, place)
    assert "b" in kept and len(kept) + read_ingested(spark, place["bad"]).count() == 2


def test_batches_take_at_most_the_asked_files_and_come_at_intervals(spark, place):
    for i in range(4):
        deliver(spark, place["in"], flight(f"f{i}"), flight(f"g{i}"))
    stream = file_stream(stream_session(spark, 2), place["in"], 1)
    query = start_ingest(stream, place["out"], place["bad"], place["audit"], place["checkpoint"], None, every="1 second")
    try:
        query.processAllAvailable()
        starts = [json.loads(p.json)["timestamp"] if hasattr(p, "json") else p["timestamp"] for p in query.recentProgress]
    finally:
        query.stop()
    assert [row[0] for row in booked(spark, place)] == [2, 2, 2, 2]
    assert len(set(starts)) >= 4
    assert len(ids(spark, place)) == 8


def test_no_batch_goes_through_the_state_without_messages(spark, place):
    deliver(spark, place["in"], flight("a"), "junk")
    query = run(spark, place)
    reports = [json.loads(p.json) if hasattr(p, "json") else p for p in query.recentProgress]
    assert [p["numInputRows"] > 0 for p in reports if "addBatch" in p["durationMs"]] == [True]
    aside = read_ingested(spark, place["bad"]).collect()
    assert [r.raw for r in aside] == ["junk"] and place["in"] in aside[0].position


def test_a_message_file_is_read_by_several_tasks(spark, sf_dir, place, monkeypatch):
    monkeypatch.setattr(streams, "ROW_GROUP_BYTES", 1 << 14)
    streams.deliver(spark, sf_dir, place["in"], F.col("delivery") == 1996)
    files = list(Path(place["in"]).rglob("*.parquet"))
    assert len(files) == 1 and pq.ParquetFile(files[0]).num_row_groups > 1


def test_kafka_source_is_limited_and_starts_at_the_beginning():
    options = kafka_options("host:9092", "flights", max_offsets=123, timeout_ms=5)
    assert options["maxOffsetsPerTrigger"] == "123" and options["startingOffsets"] == "earliest"
    assert options["kafka.bootstrap.servers"] == "host:9092" and options["subscribe"] == "flights"
    assert options["kafka.request.timeout.ms"] == options["kafka.session.timeout.ms"] == "5"


def test_bloom_stream(spark, place):
    deliver(spark, place["in"], *[flight(f"f{i}") for i in range(40)], flight("f1"))
    deliver(spark, place["in"], *[flight(f"f{i}") for i in range(20, 60)], "broken")
    run_bloom(spark, place)
    assert ids(spark, place) == sorted(f"f{i}" for i in range(60))
    deliver(spark, place["in"], flight("f0"), flight("new"))
    run_bloom(spark, place)
    assert ids(spark, place) == sorted([*(f"f{i}" for i in range(60)), "new"])


def test_bloom_filter_grows_before_it_fills(spark, place):
    growth = Growth(first_items=16, fp_rate=0.02)
    write = bloom_writer(place["out"], place["filters"], "flight_id", growth)
    new = lambda a, b: spark.createDataFrame([(f"id{i}",) for i in range(a, b)], "flight_id string")
    for batch_id, (a, b) in enumerate([(0, 10), (5, 25), (20, 90), (0, 400)]):
        write(new(a, b), batch_id)
    kept = spark.read.parquet(place["out"])
    assert kept.count() == kept.select("flight_id").distinct().count() >= 400 * (1 - growth.fp_rate) - 4
    sizes = {r.generation: r["items"] for r in FilterLog(spark, place["filters"]).before(4).filter("block is null").collect()}
    assert len(sizes) > 1 and all(n <= growth.capacity(g) for g, n in sizes.items())
    write(new(0, 400), 4)
    assert spark.read.parquet(place["out"]).count() <= 400


def test_a_lost_snapshot_stops_the_stream(spark, place):
    write = bloom_writer(place["out"], place["filters"], "flight_id")
    with pytest.raises(Exception, match="(?i)path.*not.*exist"):
        write(spark.createDataFrame([("a",)], "flight_id string"), 7)


def test_a_log_of_other_block_numbers_stops_the_stream(spark, place, monkeypatch):
    write, row = bloom_writer(place["out"], place["filters"], "flight_id"), spark.createDataFrame([("a",)], "flight_id string")
    write(row, 0)
    monkeypatch.setattr(bloom, "LANES", 1)
    with pytest.raises(FileNotFoundError, match="does not exist"):
        write(row, 1)


def test_repeated_bloom_batch_changes_nothing(spark, place):
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "flight_id string, origin string")
    write = bloom_writer(place["out"], place["filters"], "flight_id", Growth(100, 0.01))
    for batch_id in (0, 0, 1, 1):
        write(rows, batch_id)
    assert spark.read.parquet(place["out"]).count() == 2


def test_the_filter_log_follows_the_batches_and_is_folded(spark, place):
    growth, keys = Growth(20_000, 0.01), lambda a, b: spark.range(a, b).selectExpr("cast(id as string) as flight_id")
    write = bloom_writer(place["out"], place["filters"], "flight_id", growth, compact_every=4)
    log = FilterLog(spark, place["filters"])
    write(keys(0, 10_000), 0)
    for batch_id in range(1, 9):
        write(keys(10_000 + 10 * batch_id, 10_020 + 10 * batch_id), batch_id)
        if batch_id < 8:
            assert spark.read.parquet(log.place("entry", batch_id)).count() <= 21  # whatever the filter holds by then
        if batch_id in (3, 4, 7):
            write(keys(10_000 + 10 * batch_id, 10_020 + 10 * batch_id), batch_id)  # repeated after its base was written
    assert log.batches("base") == [7] and log.batches("entry") == [8]
    kept = spark.read.parquet(place["out"])
    assert kept.count() == kept.distinct().count() >= 10_090 * 0.99
    assert log.before(9).filter("block is null").first()["items"] == kept.count()
    # the log holds what a filter of all accepted keys would
    whole = bloom.build(kept.select("flight_id"), kept.flight_id, *growth.size(0))
    assert sorted(map(tuple, whole.collect())) == sorted(tuple(r)[2:] for r in log.before(9).select("generation", "items", "block", *bloom.WORDS).collect() if r.block is not None)


@pytest.mark.parametrize("limit", [bloom.BROADCAST_LIMIT_BYTES, 0])
def test_generations_are_asked_together(spark, place, monkeypatch, limit):
    monkeypatch.setattr(bloom, "BROADCAST_LIMIT_BYTES", limit)
    growth, session = Growth(first_items=16, fp_rate=0.02), stream_session(spark, 2)
    write = bloom_writer(place["out"], place["filters"], "flight_id", growth)
    new = lambda a, b: session.createDataFrame([(f"id{i}", i) for i in [*range(a, b), a, a]], "flight_id string, n int")
    for batch_id, (a, b) in enumerate([(0, 10), (5, 25), (20, 90), (0, 400), (300, 500)]):
        write(new(a, b), batch_id)
    kept = spark.read.parquet(place["out"])
    assert kept.count() == kept.select("flight_id").distinct().count() >= 500 * (1 - growth.fp_rate) - 4
    log = FilterLog(session, place["filters"])
    state = log.read(log.paths_before(5))
    held, _ = _held(state)
    assert len(held) > 2 and sum(held.values()) == kept.count()
    judged = accept_new(new(450, 600), state, held, "flight_id", growth, "xxhash64")
    assert 100 * (1 - growth.fp_rate) - 4 <= judged.count() <= 100 and judged.filter("n < 500").isEmpty()
    # whatever the number of generations, rows are dealt out by key and by lane, and generations join where they lie
    plan = judged._jdf.queryExecution().executedPlan().toString()
    joins = plan.count("Join LeftOuter") + plan.count("LeftOuter, BuildRight")
    assert joins >= len(held)
    if limit == 0:
        assert plan.count("Exchange hashpartitioning(_lane") == 1 + len(held) and "Exchange hashpartitioning(_lane#" in plan
        assert not re.search(r"Exchange hashpartitioning\(_lane#\w+, _block", plan)


def test_large_batches_are_folded_at_once(spark, place):
    growth, keys = Growth(400_000, 0.01), lambda a, b: spark.range(a, b).selectExpr("cast(id as string) as flight_id")
    write = bloom_writer(place["out"], place["filters"], "flight_id", growth)
    log = FilterLog(spark, place["filters"])
    for batch_id in range(4):
        write(keys(40_000 * batch_id, 40_000 * batch_id + 40_000), batch_id)
        read = log.read(log.paths_before(batch_id + 1)).count()
        assert read <= 2 * growth.blocks(_held(log.before(batch_id + 1))[0]) + 10  # not a block of every key that ever came
    write(keys(120_000, 160_000), 3)  # a repeated batch
    write(keys(160_000, 160_010), 4)
    write(keys(160_000, 160_010), 5)
    assert log.batches("base") == [3] and log.batches("entry") == [4, 5]
    kept = spark.read.parquet(place["out"])
    assert 160_010 * 0.99 <= kept.count() == kept.distinct().count()
    whole = bloom.build(kept, kept.flight_id, *growth.size(0))
    in_log = log.before(6).filter("block is not null").select("block", *bloom.WORDS)
    assert whole.exceptAll(in_log).isEmpty() and in_log.exceptAll(whole).isEmpty()


@pytest.mark.parametrize("unfinished", [False, True])
def test_a_gap_in_the_log_stops_the_stream(spark, place, unfinished):
    write = bloom_writer(place["out"], place["filters"], "flight_id", compact_every=3)
    row = lambda i: spark.createDataFrame([(f"id{i}",)], "flight_id string")
    for batch_id in range(5):
        write(row(batch_id), batch_id)
    entry = Path(FilterLog(spark, place["filters"]).place("entry", 3))
    for file in [entry / "_SUCCESS"] if unfinished else [*entry.iterdir()]:
        file.unlink()
    with pytest.raises(FileNotFoundError, match="does not exist"):
        write(row(9), 5)


def test_fixture_holds_the_awkward_deliveries(spark, sf_dir):
    sent = streams._sent_lines(spark, sf_dir).selectExpr("key", "delivery", "value like '%\"origin\"%' as routed", "value not like '%}' as cut")
    by_id = sent.filter("not cut").groupBy("key").agg({"routed": "max", "delivery": "count"}).collect()
    whole = {r.key for r in by_id if r["max(routed)"]}
    first = sent.filter("not cut and not routed").select("key").distinct().collect()
    assert any(r.key in whole for r in first)  # unrouted once, whole at another time


def test_ids_are_wanted_of_lines_without_a_day_as_well(spark, tmp_path):
    orders = spark.createDataFrame([(1, "O", 10.0, "1-URGENT"), (2, "F", 20.0, "5-LOW")], "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    orders.selectExpr("*", "timestamp'1995-01-02' as o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 1, 0.1, "1995-01-01"), (1, 1, 0.1, "1996-01-01"), (1, 2, 0.1, None), (1, 3, 0.0, "1997-01-01"), (2, 1, 0.1, "1996-01-01"), (2, 2, 0.1, "1997-01-01")]
    lines = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_discount double, day string")
    lines.selectExpr("*", "cast(day as timestamp) as l_shipdate").drop("day").write.parquet(f"{tmp_path}/lineitem.parquet")
    for rows in (F.col("delivery") <= 1995, F.col("delivery") > 1995):
        streams.deliver(spark, str(tmp_path), f"{tmp_path}/messages", rows)
    messages = spark.read.schema("key STRING, value BINARY").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/messages")
    assert messages.count() == 5
    assert sorted(r.flight_id for r in streams.whole_ids(spark, str(tmp_path), messages).collect()) == ["1|1", "1|2", "2|2"]


@pytest.mark.parametrize("items", [1, 64, 10_000])
def test_filter_sizes_follow_the_items(items):
    m_bits, k_hashes = bloom.sized(items, 0.01)
    assert m_bits % 64 == 0 and m_bits >= 9.5 * items and k_hashes == 7
    assert bloom.expected_fp_rate(items, m_bits, k_hashes) <= 0.01
    bloom.check_load(items, m_bits, k_hashes, 0.01)
    with pytest.raises(ValueError):
        bloom.check_load(20 * max(items, 64), m_bits, k_hashes, 0.01)
