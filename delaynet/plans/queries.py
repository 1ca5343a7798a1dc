"""Registered queries: every operator run over the whole input tables.

Each function takes (spark, sf_dir) and returns a DataFrame. Doubles are
rounded to six places where they are the result of sums or logarithms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from delaynet.functions import delay, parsing
from delaynet.functions.noise import keyed_uniform, laplace
from delaynet.operators import (
    aggregates,
    audit,
    bloom,
    clean,
    cms,
    dedup,
    graph,
    hll,
    privacy,
    ranking,
    scorecard,
    similarity,
)
from delaynet.plans import streams
from delaynet.schema import RAW_COLUMNS
from delaynet.session import materialize, scratch_path
from delaynet.sources import files, logs, messages
from delaynet.sources.tables import flights, raw_records, region_of_nation, spread, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SWEEP_WIDTHS = [10, 50, 100, 250, 500, 1000, 2000]
METHOD = "md5"  # the hash that SQL can repeat; xxhash64 is the default elsewhere
FP_RATE = 0.01  # of Bloom filters
EPSILONS = [0.01, 0.1, 0.5, 1.0, 5.0, 10.0]
TRIALS = 50


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def r6(column: str | Column) -> Column:
    return F.round(column, 6)


def c(name: str) -> Column:
    return F.col(name)


def line_id() -> Column:
    return F.concat_ws("|", c("l_orderkey").cast("string"), c("l_linenumber").cast("string"))


# --- sources and sinks ----------------------------------------------------------------


@query
def scan_parquet(spark, sf):
    return table(spark, sf, "events").filter(c("value") > 50).select("event_id", "user_id", "event_type", "value")


@query
def json_decode(spark, sf):
    schema = StructType([StructField("k", IntegerType())])
    decoded = messages.decode_json(table(spark, sf, "events").select("event_id", "props"), schema, "props")
    return decoded.filter(~messages.is_quarantined("k")).select("event_id", "k")


EVENT_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
    ]
)


def _event_messages(spark, sf):
    events = table(spark, sf, "events").select(*EVENT_SCHEMA.names)
    return events.select(c("event_id").alias("source_id"), "event_type", messages.encode_json(events).alias("value"))


@query
def json_encode(spark, sf):
    path = scratch_path(spark, "json")
    files.write_json_records(table(spark, sf, "events").select(*EVENT_SCHEMA.names), path)
    return spark.read.schema(EVENT_SCHEMA).json(path)


@query
def quarantine(spark, sf):
    """Error events arrive cut off in the middle, all others whole."""
    sent = _event_messages(spark, sf).select(
        "source_id",
        F.when(c("event_type") == "error", F.expr("left(value, length(value) - 2)")).otherwise(c("value")).alias("value"),
    )
    return messages.decode_json(sent, EVENT_SCHEMA).select(
        "source_id", messages.is_quarantined("event_id").alias("quarantined")
    )


@query
def keyed_messages(spark, sf):
    sent = messages.keyed_messages(flights(spark, sf))
    return messages.decode_json(sent).select("key", "origin", "delay_minutes")


@query
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_raw_csv(raw_records(spark, sf), path)
    raw = files.read_raw_csv(spark, path)
    return raw.groupBy("YEAR", "OP_UNIQUE_CARRIER").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(parsing.flight_number(c("OP_CARRIER_FL_NUM")).cast("long")).alias("number_sum"),
        F.count(F.when(parsing.stripped(c("DEST")) == "", 1)).alias("blank_dest"),
        F.count(F.when(parsing.is_blank(c("CRS_DEP_TIME")), 1)).alias("blank_time"),
    )


@query
def csv_quarantine(spark, sf):
    """Lines that lost or gained fields on the way are set aside with their text; the others are records."""
    path, quarantine = scratch_path(spark, "lines"), scratch_path(spark, "quarantine")
    fields = [F.coalesce(c(name), F.lit("")) for name in RAW_COLUMNS]
    whole, cut = F.concat_ws(",", *fields), F.concat_ws(",", *fields[:-3])
    line = F.when(c("DEST") == "", cut).when(c("CRS_DEP_TIME") == "x12", F.concat(whole, F.lit(",surplus"))).otherwise(whole)
    raw_records(spark, sf).select(line.alias("line")).write.text(path)
    good = files.ingest_csv(spark, quarantine, path, header=False).select(F.lit("record").alias("kind"), "OP_UNIQUE_CARRIER", F.lit(None).cast("string").alias("raw"))
    bad = spark.read.parquet(quarantine).filter("position is not null and source_file is not null")
    aside = bad.select(F.lit("aside").alias("kind"), F.split("raw", ",")[RAW_COLUMNS.index("OP_UNIQUE_CARRIER")].alias("OP_UNIQUE_CARRIER"), "raw")
    surplus = F.count(F.when(c("raw").endswith(",surplus"), 1)).alias("surplus")
    return good.unionByName(aside).groupBy("kind", "OP_UNIQUE_CARRIER").agg(F.count(F.lit(1)).alias("n"), surplus)


@query
def multi_file_scan(spark, sf):
    """One folder of files per month of the year, read back in one scan."""
    path = scratch_path(spark, "monthly")
    raw = raw_records(spark, sf).withColumn("file_month", c("MONTH"))
    raw.write.partitionBy("file_month").csv(path, header=True, emptyValue="", nullValue="")
    month = F.regexp_extract("source_file", r"file_month=(\d+)", 1).cast("int")
    return files.read_raw_csv(spark, path).groupBy(month.alias("file_month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(parsing.parse_int(c("MONTH")) == month, 1)).alias("matching"),
    )


@query
def curated_sink(spark, sf):
    path = scratch_path(spark, "curated")
    files.append_curated(flights(spark, sf), path)
    return files.read_curated(spark, path).groupBy("origin", "delay_cause").agg(
        F.count(F.lit(1)).alias("n"), F.sum("delay_minutes").alias("minutes")
    )


@query
def result_sink(spark, sf):
    folder = scratch_path(spark, "results")
    edges = materialize(aggregates.route_edges(flights(spark, sf, "origin", "destination", "delay_minutes")), "edges")
    components = graph.connected_components(_home_graph(spark, sf))
    tables = {"edges": edges, "components": components, "component_sizes": graph.component_sizes(components)}
    files.write_results(tables, folder)
    files.write_results(tables, folder)
    read = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in tables}
    return (
        read["edges"]
        .select(F.lit("edges").alias("name"), F.concat_ws("-", "origin", "destination").alias("key"), c("weight").cast("string").alias("value"))
        .unionByName(read["components"].select(F.lit("components").alias("name"), c("airport").alias("key"), c("component_id").alias("value")))
        .unionByName(
            read["component_sizes"].select(
                F.lit("component_sizes").alias("name"), c("component_id").alias("key"), c("size").cast("string").alias("value")
            )
        )
    )


@query
def report_sink(spark, sf):
    path = scratch_path(spark, "report")
    report = _attribution(spark, sf).withColumn("avg_delay", r6("avg_delay"))
    files.write_report(report, path, [F.desc("flight_count"), c("origin"), c("carrier")], 50)
    return spark.read.schema("origin STRING, carrier STRING, flight_count LONG, avg_delay DOUBLE").csv(path, header=True)


@query
def map_export(spark, sf):
    places = table(spark, sf, "nation").select(
        c("n_name").alias("airport"),
        (c("n_nationkey") * 3.0 - 30).alias("lat"),
        (c("n_nationkey") * 5.0 - 60).alias("lng"),
    )
    edges = _edges(spark, sf)
    ranks = graph.pagerank(edges, weight=c("weight"))
    components = graph.connected_components(_home_graph(spark, sf))
    exported = ranking.mapped_only(ranking.attach_coordinates(ranks, components, places))
    path = scratch_path(spark, "map")
    files.write_json_records(exported.withColumn("pagerank", r6("pagerank")), path)
    return spark.read.schema("airport STRING, pagerank DOUBLE, component_id STRING, lat DOUBLE, lng DOUBLE").json(path)


def _log_line(text: str, value: Column, unit: str = "") -> Column:
    return F.concat(F.lit(text), value.cast("string"), F.lit(unit))


_RUN = r"^\[run (\d+)\] "


def _written_logs(spark, sf, lines: Column, runs: bool = False) -> DataFrame:
    """One log per day with the lines of each event in order, written as text and read back.

    A long log is several files, cut by event; their names and positions keep the order.
    With `runs`, each line says which event it is of, and every event is a source of its own.
    """
    schema = StructType([StructField("k", IntegerType())])
    events = messages.decode_json(table(spark, sf, "events"), schema, "props").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    path = scratch_path(spark, "logs")
    ordered = events.repartitionByRange("day", "event_id").sortWithinPartitions("day", "event_id")
    line = F.concat(F.lit("[run "), c("event_id").cast("string"), F.lit("] "), c("line")) if runs else c("line")
    ordered.withColumn("line", F.explode(lines)).select("day", line.alias("line")).write.partitionBy("day").text(path)
    source = F.regexp_extract(logs.FILE, "day=([^/]+)/", 1)
    if runs:
        source = F.concat(source, F.lit("#"), F.regexp_extract("value", _RUN, 1))
    return logs.read_log_lines(spark, path, source=source)


@query
def log_metrics(spark, sf):
    """Every event written as the result lines of a run in its day's log, and parsed from there."""
    unit = F.when(c("event_type") == "error", F.lit("K")).when(c("event_type") == "click", F.lit("G")).otherwise(F.lit("M"))
    lines = F.array(
        F.lit("--- Throughput ---"),
        _log_line("Records accepted:     ", c("event_id")),
        _log_line("ETL Throughput:       ~", c("value"), " records/sec"),
        _log_line("Spark Streaming ETL:  ", c("user_id"), "s"),
        F.concat(_log_line("Curated Parquet:      ", c("k")), unit),
    )
    return logs.run_metrics(_written_logs(spark, sf, lines, runs=True)).withColumn("parquet_mb", r6("parquet_mb"))


@query
def log_sweeps(spark, sf):
    """Each day's events as a log: errors start a section, others are table rows."""
    row = F.concat(F.lit("  "), c("k").cast("string"), F.lit("     | "), c("value").cast("string"))
    line = F.when(c("event_type") == "error", F.lit("[B] Sweeping Privacy Budgets (Epsilons)")).otherwise(row)
    return logs.sweep_rows(_written_logs(spark, sf, F.array(line)), "epsilon").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("parameter").alias("parameters"), r6(F.sum("error")).alias("errors")
    )


# --- row normalisation and scalar expressions -----------------------------------------------


@query
def normalize_row(spark, sf):
    return parsing.normalize(raw_records(spark, sf))


@query
def hhmm_to_iso(spark, sf):
    raw = raw_records(spark, sf).select("YEAR", "MONTH", "DAY_OF_MONTH", "CRS_DEP_TIME").distinct()
    iso = parsing.departure_iso(c("YEAR"), c("MONTH"), c("DAY_OF_MONTH"), c("CRS_DEP_TIME"))
    return raw.withColumn("scheduled_departure", iso)


@query
def delay_cause_argmax(spark, sf):
    raw = raw_records(spark, sf)
    return raw.groupBy("OP_UNIQUE_CARRIER", parsing.dominant_cause().alias("delay_cause")).agg(F.count(F.lit(1)).alias("n"))


@query
def composite_id(spark, sf):
    return parsing.normalize(raw_records(spark, sf)).groupBy("flight_id").agg(F.count(F.lit(1)).alias("n"))


@query
def clamp_round(spark, sf):
    raw = raw_records(spark, sf)
    return raw.groupBy("DEP_DELAY", parsing.delay_minutes(c("DEP_DELAY")).alias("delay_minutes")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _tokens(bucket: int) -> Column:
    return delay.delay_token(c("delay_minutes"), c("delay_cause"), bucket)


@query
def delay_tokens(spark, sf):
    rows = flights(spark, sf, "delay_minutes", "delay_cause")
    tokens = delay.delay_tokens(c("delay_minutes"), c("delay_cause"))
    return aggregates.counts_by(rows.select(F.explode(tokens).alias("token")), "token")


@query
def token_vocabulary(spark, sf):
    return similarity.token_vocabulary(flights(spark, sf, "delay_minutes", "delay_cause"), _tokens(5))


@query
def hour_of_day(spark, sf):
    rows = flights(spark, sf, "scheduled_departure")
    return aggregates.counts_by(rows.select(delay.hour_of_day(c("scheduled_departure")).alias("hour")), "hour")


@query
def time_block(spark, sf):
    hour = delay.hour_of_day(c("scheduled_departure"))
    rows = flights(spark, sf, "scheduled_departure").select(hour.alias("hour"), delay.time_block(hour).alias("time_block"))
    return aggregates.counts_by(rows, "hour", "time_block")


@query
def delay_bin(spark, sf):
    rows = flights(spark, sf, "delay_minutes")
    return aggregates.counts_by(rows.select("delay_minutes", delay.delay_bin(c("delay_minutes")).alias("delay_bin")), "delay_minutes", "delay_bin")


@query
def generalize(spark, sf):
    return privacy.generalize(flights(spark, sf))


@query
def split_carrier(spark, sf):
    rows = flights(spark, sf, "flight_id").select(delay.carrier_of(c("flight_id")).alias("carrier"))
    return aggregates.counts_by(rows, "carrier")


# --- filters and samples ----------------------------------------------------------------


def _gappy(spark, sf):
    """Flights with gaps: unknown origin on round trips, no delay for `nas` rows on
    the hour 0, no cause for on-time rows."""
    rows = flights(spark, sf, "origin", "destination", "scheduled_departure", "delay_minutes", "delay_cause")
    midnight = F.substring("scheduled_departure", 12, 2) == "00"
    return rows.withColumns(
        {
            "origin": F.nullif("origin", "destination"),
            "delay_minutes": F.when(~(midnight & (c("delay_cause") == "nas")), c("delay_minutes")),
            "delay_cause": F.nullif("delay_cause", F.lit("on_time_or_no_cause")),
        }
    )


@query
def clean_rows(spark, sf):
    return aggregates.counts_by(clean.clean_rows(_gappy(spark, sf)), "origin", "delay_cause")


@query
def drop_unrouted(spark, sf):
    return aggregates.counts_by(clean.drop_unrouted(_gappy(spark, sf)), "origin")


@query
def hash_sample(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    return clean.hash_sample(events, c("event_id").cast("string"))


@query
def limit_n(spark, sf):
    return clean.first_n(table(spark, sf, "events").select("event_id", "user_id", "value"), 100, F.desc("value"), "event_id")


@query
def uniform_n(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    return clean.uniform_n(events, 100, c("event_id").cast("string"))


# --- joins and deduplication --------------------------------------------------------------


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(*LINE_COLUMNS)


@query
def semi_join_ids(spark, sf):
    accepted = table(spark, sf, "orders").filter(c("o_orderpriority") == "1-URGENT").select(c("o_orderkey").alias("l_orderkey"))
    return dedup.accepted_only(_lines(spark, sf), accepted, "l_orderkey")


@query
def anti_join_seen(spark, sf):
    lines = _lines(spark, sf)
    return dedup.not_seen(
        lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag <> 'R'"), "l_orderkey", "l_linenumber"
    )


@query
def dedup_batch(spark, sf):
    return dedup.dedup_batch(_lines(spark, sf), "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber")


@query
def dedup_keep_first(spark, sf):
    return dedup.keep_first(_lines(spark, sf), ["l_orderkey", "l_linenumber"])


@query
def dedup_audit(spark, sf):
    lines = table(spark, sf, "lineitem")
    return dedup.batch_audit(lines, F.year("l_shipdate"), "l_orderkey", "l_linenumber")


@query
def rank_side_by_side(spark, sf):
    return ranking.side_by_side(_our_ranking(spark, sf, 20), _their_ranking(spark, sf, 30))


# --- aggregates -------------------------------------------------------------------------------


@query
def row_count(spark, sf):
    return aggregates.row_count(flights(spark, sf, "flight_id"))


@query
def counts_by_origin(spark, sf):
    return aggregates.counts_by(flights(spark, sf, "origin"), "origin").orderBy(F.desc("n"), "origin")


@query
def route_edges(spark, sf):
    return aggregates.route_edges(flights(spark, sf, "origin", "destination", "delay_minutes"))


def _attribution(spark, sf):
    rows = flights(spark, sf, "flight_id", "origin", "delay_minutes")
    return aggregates.hub_attribution(rows, delay.carrier_of(c("flight_id")))


@query
def hub_attribution(spark, sf):
    top = _attribution(spark, sf).orderBy(F.desc("flight_count"), "origin", "carrier").limit(50)
    return top.withColumn("avg_delay", r6("avg_delay"))


@query
def fairness(spark, sf):
    majors = ["Brand#1", "Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15"]
    rows = flights(spark, sf, "flight_id", "delay_minutes")
    result = aggregates.fairness(rows, delay.carrier_of(c("flight_id")), majors)
    return result.withColumn("mean_delay_minutes", r6("mean_delay_minutes"))


@query
def distinct_routes(spark, sf):
    return aggregates.distinct_routes(flights(spark, sf, "origin", "destination"))


@query
def top_keys(spark, sf):
    return aggregates.top_counts(flights(spark, sf, "tail_number"), "tail_number", 100)


@query
def approx_top_keys(spark, sf):
    return aggregates.approx_top_counts(flights(spark, sf, "tail_number"), "tail_number", 5)


TRACKED = 512


@query
def heavy_hitters(spark, sf):
    """Keys that sketches promise to list, for each flag from its own state and for all from the combined ones, against exact counts."""
    part = c("l_partkey").cast("string")
    key = F.when(c("l_partkey") % 10 < 3, F.concat(F.lit("H"), (c("l_partkey") % 5).cast("string"))).otherwise(part)
    lines = spread(table(spark, sf, "lineitem"), "l_orderkey").select(c("l_returnflag").alias("span"), key.alias("key"))
    states = materialize(aggregates.top_key_states(lines, c("span"), c("key"), TRACKED), "states")
    found = aggregates.heavy_keys(states, TRACKED, c("span")).unionByName(aggregates.heavy_keys(states, TRACKED))
    exact = lines.withColumn("span", F.explode(F.array(c("span"), F.lit("all")))).groupBy("span", "key").agg(F.count(F.lit(1)).alias("exact"))
    totals = exact.groupBy("span").agg(F.sum("exact").alias("rows"))
    promised = exact.join(totals, "span").filter(c("exact") > 2 * aggregates.top_key_error(TRACKED) * c("rows"))
    within = (c("n") >= c("exact")) & (c("n") <= c("exact") + c("error"))
    return promised.join(found, ["span", "key"], "left").select("span", "key", "exact", F.coalesce(within, F.lit(False)).alias("listed_within_error"))


# --- sketches ---------------------------------------------------------------------------------


def _routes(spark, sf):
    return flights(spark, sf, "origin", "destination").select(delay.route(c("origin"), c("destination")).alias("route"))


@query
def hll_registers(spark, sf):
    return hll.registers(_routes(spark, sf), c("route"), 12, METHOD)


@query
def hll_estimate(spark, sf):
    items = table(spark, sf, "lineitem").select(c("l_orderkey").cast("string").alias("item"))
    return hll.estimate(hll.registers(items, c("item"), 10, METHOD), 10).withColumn("estimate", r6("estimate"))


@query
def hll_merge(spark, sf):
    """A sketch per kind of line, built in one scan and merged."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", c("l_partkey").cast("string").alias("item"))
    kinds = hll.registers(lines, c("item"), 12, METHOD, by=("l_returnflag",))
    return hll.estimate(hll.merge(kinds), 12).withColumn("estimate", r6("estimate"))


@query
def hll_ranges(spark, sf):
    """Distinct orders up to each year from monthly sketches that were written once, against exact counts."""
    lines = spread(table(spark, sf, "lineitem"), "l_orderkey").select("l_orderkey", F.trunc("l_shipdate", "month").alias("month"))
    stored = materialize(hll.stored_sketches(lines, c("month"), c("l_orderkey")), "sketches")
    last = lines.agg(F.max(F.year("month"))).first()[0] or 0  # one value: an empty table has no ranges
    until = F.explode(F.sequence(F.year("month"), F.lit(last))).alias("until")
    estimates = hll.united(stored.withColumnRenamed("span", "month").select(until, "sketch"), "until")
    first = lines.groupBy("l_orderkey").agg(F.min(F.year("month")).alias("year")).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    exact = first.select(F.explode(F.sequence(c("year"), F.lit(last))).alias("until"), "n").groupBy("until").agg(F.sum("n").alias("exact"))
    close = F.abs(c("estimate") - c("exact")) <= 3 * hll.stored_error() * c("exact")
    return estimates.join(exact, "until").select("until", "exact", close.alias("within_three_errors"))


@query
def hll_vs_exact(spark, sf):
    result = scorecard.hll_vs_exact(_routes(spark, sf), c("route"), 12, METHOD)
    return result.withColumns({"estimate": r6("estimate"), "error_pct": r6("error_pct")})


@query
def approx_distinct(spark, sf):
    """Spark's own sketches, judged by three standard errors around the exact count."""
    keys = table(spark, sf, "lineitem").select("l_orderkey")
    exact = keys.distinct().agg(F.count(F.lit(1)).alias("exact"))
    rough = keys.agg(
        F.approx_count_distinct("l_orderkey", 0.02).alias("a"),
        F.hll_sketch_estimate(F.hll_sketch_agg("l_orderkey", F.lit(12))).alias("b"),
    )

    def within(estimate: str, error: float) -> Column:
        return F.abs(rough.select(estimate).scalar() - c("exact")) <= c("exact") * (3 * error)

    return exact.select("exact", within("a", 0.02).alias("builtin_ok"), within("b", 0.0163).alias("sketch_ok"))


def _tail_counts(spark, sf):
    tails = flights(spark, sf, "tail_number").select(F.nullif(F.trim("tail_number"), F.lit("")).alias("tail_number"))
    return materialize(aggregates.counts_by(tails.na.drop(), "tail_number"), "tails")


@query
def cms_table(spark, sf):
    return cms.build(flights(spark, sf, "tail_number"), "tail_number", depth=5, widths=50, method=METHOD)


@query
def cms_estimate(spark, sf):
    tails = flights(spark, sf, "tail_number")
    sketch = cms.build(tails, "tail_number", depth=5, widths=50, method=METHOD)
    return cms.probe(sketch, tails, "tail_number", depth=5, widths=50, method=METHOD).select("tail_number", "estimate")


@query
def cms_vs_exact(spark, sf):
    return scorecard.cms_vs_exact(_tail_counts(spark, sf), "tail_number", width=50, method=METHOD)


@query
def cms_width_sweep(spark, sf):
    result = cms.width_sweep(_tail_counts(spark, sf), "tail_number", SWEEP_WIDTHS, method=METHOD)
    return result.withColumns({"mae": r6("mae"), "kilobytes": r6("kilobytes")})


def _user(name: str = "user_id") -> Column:
    return c(name).cast("string")


@query
def bloom_bits(spark, sf):
    """The set bits of a filter of all users, sized for them."""
    events = table(spark, sf, "events")
    m_bits, k_hashes = bloom.sized(events.agg(F.countDistinct("user_id")).first()[0], FP_RATE)
    return bloom.set_bits(bloom.build(events, _user(), m_bits, k_hashes, METHOD))


@query
def bloom_probe(spark, sf):
    """Which users the filter of buyers claims to hold, against who bought; as many strangers are asked about."""
    events = table(spark, sf, "events")
    buyers = events.filter("event_type = 'purchase'")
    m_bits, k_hashes = bloom.sized(buyers.count(), FP_RATE)
    built = materialize(bloom.build(buyers, _user(), m_bits, k_hashes, METHOD), "filter")
    users = events.groupBy("user_id").agg(F.max(c("event_type") == "purchase").alias("added"))
    strangers = users.select((c("user_id") + 1_000_000_000).alias("user_id"), F.lit(False).alias("added"))
    return bloom.might_contain(users.unionByName(strangers), _user(), built, m_bits, k_hashes, METHOD)


@query
def bloom_dedup(spark, sf):
    """Second delivery tested against the filter of the first, sized by the rows of the first."""
    lines = spread(table(spark, sf, "lineitem"), "l_orderkey").select(line_id().alias("record_id"), "l_returnflag")
    earlier = lines.filter("l_returnflag <> 'R'")
    m_bits, k_hashes = bloom.sized(table(spark, sf, "lineitem").filter("l_returnflag <> 'R'").count(), FP_RATE)
    first = materialize(bloom.build(earlier, c("record_id"), m_bits, k_hashes, METHOD), "filter")
    second = lines.filter("l_returnflag = 'R'").select("record_id").distinct()
    judged = bloom.might_contain(second, c("record_id"), first, m_bits, k_hashes, METHOD)
    return judged.select("record_id", (~c("maybe_seen")).alias("accepted"))


@query
def sketch_scorecard(spark, sf):
    counts = aggregates.counts_by(table(spark, sf, "lineitem").select(c("l_partkey").cast("string").alias("key")), "key")
    outsiders = table(spark, sf, "part").select(F.concat(F.lit("X"), c("p_partkey").cast("string")).alias("key"))
    result = scorecard.sketch_scorecard(materialize(counts, "parts"), outsiders, "key", fp_rate=FP_RATE, method=METHOD)
    return result.withColumn("accuracy_pct", r6("accuracy_pct"))


# --- graph ------------------------------------------------------------------------------------


def _edges(spark, sf):
    return materialize(aggregates.route_edges(flights(spark, sf, "origin", "destination", "delay_minutes")), "edges")


def _home_graph(spark, sf):
    """Every customer and supplier points to its nation, every nation to its region: one component per region."""
    nation = table(spark, sf, "nation")
    customer = table(spark, sf, "customer").join(nation, c("c_nationkey") == c("n_nationkey"))
    supplier = table(spark, sf, "supplier").join(nation, c("s_nationkey") == c("n_nationkey"))
    edges = customer.select(F.concat(F.lit("C"), c("c_custkey").cast("string")).alias("origin"), c("n_name").alias("destination"))
    edges = edges.unionByName(supplier.select(F.concat(F.lit("S"), c("s_suppkey").cast("string")).alias("origin"), c("n_name").alias("destination")))
    regions = region_of_nation(spark, sf).select(c("airport").alias("origin"), c("region").alias("destination"))
    return materialize(edges.unionByName(regions).withColumn("weight", F.lit(1).cast("bigint")), "homes")


def _trade_edges(spark, sf):
    """Customers to suppliers by quantity; returned lines point back."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", F.coalesce(c("l_returnflag") == "R", F.lit(False)).alias("back")
    )
    joined = lines.join(orders, c("l_orderkey") == c("o_orderkey"))
    # grouped by the numbers, named afterwards
    routes = joined.groupBy("back", "o_custkey", "l_suppkey").agg(F.sum(c("l_quantity").cast("long")).alias("weight"))
    customer = F.concat(F.lit("C"), c("o_custkey").cast("string"))
    supplier = F.concat(F.lit("S"), c("l_suppkey").cast("string"))
    return routes.select(
        F.when(c("back"), supplier).otherwise(customer).alias("origin"),
        F.when(c("back"), customer).otherwise(supplier).alias("destination"),
        "weight",
    )


def _trade_graph(spark, sf):
    return materialize(_trade_edges(spark, sf), "trade")


@query
def graph_vertices(spark, sf):
    return graph.graph_vertices(_edges(spark, sf))


@query
def graph_stats(spark, sf):
    return graph.graph_stats(_trade_graph(spark, sf))


def _rounded(ranks):
    return ranks.withColumn("pagerank", r6("pagerank"))


@query
def pagerank(spark, sf):
    return _rounded(graph.pagerank(_home_graph(spark, sf)))


@query
def pagerank_weighted(spark, sf):
    return _rounded(graph.pagerank(_edges(spark, sf), weight=c("weight")))


@query
def pagerank_trade(spark, sf):
    return _rounded(graph.pagerank(_trade_graph(spark, sf)))


@query
def top_hubs(spark, sf):
    return _rounded(graph.top_hubs(_rounded(graph.pagerank(_trade_graph(spark, sf))), 20))


@query
def connected_components(spark, sf):
    return graph.connected_components(_home_graph(spark, sf))


@query
def components_trade(spark, sf):
    return graph.connected_components(_trade_graph(spark, sf))


@query
def component_sizes(spark, sf):
    return graph.component_sizes(graph.connected_components(_home_graph(spark, sf)))


# --- similarity ---------------------------------------------------------------------------------


def _bags(spark, sf, bucket: int, cleaned: bool = True):
    rows = flights(spark, sf, "origin", "destination", "delay_minutes", "delay_cause")
    rows = clean.clean_rows(rows) if cleaned else rows
    return similarity.token_bags(rows, delay.group_id(c("origin"), c("destination")), _tokens(bucket))


def _signed(spark, sf, bucket: int, cleaned: bool = True):
    """Bags and the signatures of their profiles, each written once."""
    bags = materialize(_bags(spark, sf, bucket, cleaned), "bags")
    return bags, materialize(similarity.minhash_signatures(similarity.profiles(bags)), "signatures")


@query
def token_bags(spark, sf):
    return _bags(spark, sf, 5).select("group_id", F.concat_ws(",", "tokens").alias("tokens"))


@query
def minhash_signatures(spark, sf):
    return similarity.minhash_signatures(_bags(spark, sf, 15)).select("group_id", "h0", "h1", "h2")


@query
def lsh_candidates(spark, sf):
    _, signatures = _signed(spark, sf, 15)
    return similarity.bucket_occupancy(signatures)


@query
def lsh_similarity_join(spark, sf):
    _, signatures = _signed(spark, sf, 15)
    return similarity.lsh_pairs(signatures, 0.3).withColumn("jaccard_distance", r6("jaccard_distance"))


@query
def exact_jaccard_join(spark, sf):
    profiles = materialize(similarity.profiles(_bags(spark, sf, 15)), "profiles")
    return similarity.exact_pairs(profiles, 0.3).withColumn("jaccard_distance", r6("jaccard_distance"))


@query
def similar_routes(spark, sf):
    bags, signatures = _signed(spark, sf, 15)
    return similarity.closest_pairs(lambda limit: similarity.lsh_pairs(signatures, limit), bags, 10, 0.85, digits=3)


@query
def similar_routes_directed(spark, sf):
    """The second report: all rows as they are, every pair in both orders."""
    bags, signatures = _signed(spark, sf, 15, cleaned=False)
    return similarity.closest_pairs(lambda limit: similarity.lsh_pairs(signatures, limit), bags, 100, 0.3, digits=6, directed=True)


@query
def lsh_quality(spark, sf):
    _, signatures = _signed(spark, sf, 15)
    quality = similarity.lsh_quality(signatures, similarity.exact_pairs(signatures, 0.3, "h0", "h1", "h2"))
    quality = materialize(quality, "quality")
    return quality.withColumn("pr_auc", r6(similarity.pr_area(quality).scalar())).withColumns(
        {"precision": r6("precision"), "recall": r6("recall")}
    )


@query
def lsh_recall_sample(spark, sf):
    """Recall from up to 200 profiles a stratum, each searched exactly."""
    _, signatures = _signed(spark, sf, 15)
    quality = similarity.sampled_quality(signatures, 0.3, per_stratum=200, method="md5")
    return quality.withColumns({name: r6(name) for name in ("true_pairs", "hits", "precision", "recall", "recall_low", "recall_high")})


@query
def similarity_clusters(spark, sf):
    bags = materialize(_bags(spark, sf, 15), "bags")
    profiles = materialize(similarity.profiles(bags), "profiles")
    return similarity.clusters(bags, profiles, similarity.cluster_components(profiles, 0.3))


# --- privacy --------------------------------------------------------------------------------------


def _origin_counts(spark, sf):
    return aggregates.counts_by(flights(spark, sf, "origin").na.drop(), "origin")


@query
def laplace_noise(spark, sf):
    """Noise of repeated releases of each count, and the counts with it."""
    draws = _origin_counts(spark, sf).withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(TRIALS - 1))))
    noise = laplace(2.0, keyed_uniform(c("origin"), c("trial")))
    return draws.select("origin", "trial", r6(noise).alias("noise"), r6(c("n") + noise).alias("released"))


@query
def dp_counts(spark, sf):
    released = privacy.noisy_counts(_origin_counts(spark, sf), 0.5, keyed_uniform(c("origin")))
    top = released.orderBy(F.desc("n"), "origin").limit(10)
    return top.withColumns({"noisy": r6("noisy"), "abs_error": r6("abs_error")})


@query
def dp_epsilon_sweep(spark, sf):
    uniform = keyed_uniform(c("origin"), c("trial"))
    return privacy.epsilon_sweep(_origin_counts(spark, sf), EPSILONS, TRIALS, uniform).withColumn("mae", r6("mae"))


@query
def dp_leakage_audit(spark, sf):
    uniform = keyed_uniform(c("origin"), c("trial"))
    result = privacy.leakage_audit(_origin_counts(spark, sf), EPSILONS, TRIALS, uniform)
    return result.withColumns({"overlap": r6("overlap"), "accuracy": r6("accuracy")})


@query
def k_anonymity(spark, sf):
    return privacy.k_anonymous(privacy.generalize(flights(spark, sf)), 5)


@query
def k_suppression(spark, sf):
    return privacy.suppressed(privacy.generalize(flights(spark, sf)), 5)


# --- ranking validation -----------------------------------------------------------------------------


def _our_scores(spark, sf):
    """Airports by the delay that reaches them over all routes."""
    return _rounded(graph.pagerank(_edges(spark, sf), weight=c("weight")))


def _their_scores(spark, sf):
    rows = flights(spark, sf, "destination").withColumnRenamed("destination", "airport")
    return aggregates.counts_by(rows, "airport")


def _our_ranking(spark, sf, limit):
    return materialize(ranking.ranked(_our_scores(spark, sf), "airport", "pagerank", limit), "ours")


def _their_ranking(spark, sf, limit):
    return materialize(ranking.ranked(_their_scores(spark, sf), "airport", "n", limit), "theirs")


@query
def precision_at_k(spark, sf):
    result = ranking.precision_at_k(_our_ranking(spark, sf, 30), _their_ranking(spark, sf, 30))
    return result.withColumn("precision_pct", r6("precision_pct"))


@query
def overlap_curve(spark, sf):
    curve = ranking.overlap_curve(_our_ranking(spark, sf, 30), _their_ranking(spark, sf, 30), [5, 10, 15, 20, 25, 30])
    return curve.withColumn("overlap_pct", r6("overlap_pct"))


@query
def ranking_overlap(spark, sf):
    result = ranking.ranking_overlap(_our_ranking(spark, sf, 20), _their_ranking(spark, sf, 20))
    return result.withColumn("overlap_pct", r6("overlap_pct"))


@query
def validation_summary(spark, sf):
    """Overlap of the two rankings at 10 and 20, and of the top two of each region."""
    ours, theirs = materialize(_our_scores(spark, sf), "ours"), materialize(_their_scores(spark, sf), "theirs")
    result = ranking.regional_overlap(ours, "pagerank", theirs, "n", region_of_nation(spark, sf), 2)
    for k in (10, 20):
        left, right = ranking.ranked(ours, "airport", "pagerank", k), ranking.ranked(theirs, "airport", "n", k)
        overlap = ranking.ranking_overlap(left, right, k).select(F.lit(f"top {k}").alias("metric"), "overlap_pct")
        result = result.unionByName(overlap)
    return result.withColumn("overlap_pct", r6("overlap_pct"))


# --- audits -----------------------------------------------------------------------------------------


@query
def data_quality(spark, sf):
    rows = parsing.normalize(raw_records(spark, sf)).drop("rejected", "carrier")
    rows = rows.withColumn("departed", c("scheduled_departure").try_cast("timestamp_ntz"))
    result = audit.data_quality(
        rows, "flight_id", "departed", ["tail_number", "origin", "destination"], F.lit("2005-01-01 00:00:00").cast("timestamp_ntz")
    )
    return result.withColumns({name: r6(name) for name in ("compliance_pct", "null_density_pct", "duplicate_pct")})


@query
def throughput_windows(spark, sf):
    result = audit.throughput_windows(table(spark, sf, "events"), "ts", "value")
    return result.withColumns({"window_start": c("window_start").cast("string"), "records_per_sec": r6("records_per_sec")})


@query
def quantile_sketches(spark, sf):
    """Percentiles of days, months and all events from daily sketches, by their true rank among the rows."""
    events = table(spark, sf, "events").select("ts", "value")
    stored = materialize(audit.quantile_sketches(events, "ts", "value"), "quantiles")
    spans = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "all": "'all'"}
    found = [audit.sketched_percentiles(stored, (50, 99), F.date_format("window_start", shape)).withColumn("level", F.lit(level)) for level, shape in spans.items()]
    found = found[0].unionByName(found[1]).unionByName(found[2])
    named = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.date_format("ts", shape).alias("span")) for level, shape in spans.items()]))
    placed = events.select("value", named.alias("n")).select("value", "n.*").join(F.broadcast(found), ["level", "span"])

    def close(p: int) -> Column:
        """Whether the wanted rank lies between the ranks of smaller and of equal values, give or take the sketch's error."""
        below, upto = F.avg((c("value") < c(f"p{p}")).cast("int")), F.avg((c("value") <= c(f"p{p}")).cast("int"))
        slack = 2 * audit.RANK_ERROR + 1 / F.count(F.lit(1))
        return ((below <= p / 100 + slack) & (upto >= p / 100 - slack)).alias(f"p{p}_close")

    return placed.groupBy("level", "span").agg(F.max("records").alias("records"), close(50), close(99))


@query
def tier_summary(spark, sf):
    result = audit.tier_summary(table(spark, sf, "events"), "ts", [1, 7, 30])
    return result.withColumns({"records_per_sec": r6("records_per_sec"), "growth": r6("growth")})


@query
def hub_scorecard(spark, sf):
    volumes = _origin_counts(spark, sf).withColumnRenamed("origin", "airport")
    result = audit.hub_scorecard(materialize(_our_scores(spark, sf), "ranks"), materialize(volumes, "volumes"))
    return result.withColumns({"relative_rank": r6("relative_rank"), "amplification": r6("amplification")})


# --- streams ------------------------------------------------------------------------------------------


@query
def stream_ingest(spark, sf):
    return streams.ingest(spark, sf).curated.select("flight_id", "flight_number", "origin", "destination", "delay_minutes")


@query
def stream_dedup(spark, sf):
    """The written audit of all batches; its parts add up to the messages."""
    run = streams.ingest(spark, sf)
    names = ("messages", "accepted", "dupes", "quarantined", "unrouted")
    return run.audit.agg(*[F.sum(name).alias(name) for name in names])


@query
def stream_quarantine(spark, sf):
    return streams.ingest(spark, sf).rejected.groupBy("raw", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def bloom_stream(spark, sf):
    """What approximate deduplication keeps to: no id twice, at most a small share of ids lost, every message accounted for."""
    run = streams.bloom_ingest(spark, sf)
    per_id = run.curated.groupBy("flight_id").agg(F.count(F.lit(1)).alias("n"))
    kept = per_id.agg(F.count(F.lit(1)).alias("ids"), F.max("n").alias("most"))
    booked = run.audit.agg(*[F.sum(name).alias(name) for name in ("messages", "accepted", "dupes", "quarantined", "unrouted")])
    wanted = streams.whole_ids(spark, sf, run.messages)
    whole = c("messages") == c("accepted") + c("dupes") + c("quarantined") + c("unrouted")
    return booked.select(
        "messages", "quarantined", "unrouted", whole.alias("adds_up"),
        (c("accepted") == kept.select("ids").scalar()).alias("all_written"),
        (kept.select("most").scalar() == 1).alias("each_id_once"),
        (c("accepted") >= wanted.agg(F.count(F.lit(1))).scalar() * F.lit(0.99)).alias("within_rate"),
        (c("accepted") <= wanted.agg(F.count(F.lit(1))).scalar()).alias("no_more_than_new"),
    )
