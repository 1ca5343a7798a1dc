"""Grouped counts, route edges, attribution and top lists."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.functions import delay


def row_count(rows: DataFrame, name: str = "n") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(name))


def counts_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def top_counts(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The `n` most frequent non-blank keys, ties by key."""
    known = rows.select(F.nullif(F.trim(F.col(key)), F.lit("")).alias(key)).na.drop()
    return counts_by(known, key).orderBy(F.desc("n"), key).limit(n)


def approx_top_counts(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Frequent keys from a bounded sketch, without shuffling the keys."""
    top = rows.agg(F.expr(f"approx_top_k({key}, {n})").alias("top"))
    return top.select(F.inline("top")).select(F.col("item").alias(key), F.col("count").alias("n"))


def top_key_error(tracked: int) -> float:
    """The most that counts from sketches of so many tracked keys are too high, as a share of all rows, guaranteed.

    Sketches keep a table of a power of two that `tracked` keys fill to three quarters;
    3.5 is the sketch's published bound, a fixed value.
    """
    return 3.5 / (1 << math.ceil(math.log2(math.ceil(tracked / 0.75))))


def top_key_states(rows: DataFrame, span: Column, key: Column, tracked: int) -> DataFrame:
    """`span, rows, state`: one sketch of the frequent keys for each span, to be stored and combined.

    A state has at most `tracked` keys, whatever the span holds. Blank and null keys do not count.
    """
    known = rows.select(span.alias("span"), F.nullif(F.trim(key), F.lit("")).alias("key")).filter("key is not null")
    return known.groupBy("span").agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(key, {int(tracked)})").alias("state"))


def heavy_keys(states: DataFrame, tracked: int, by: Column | None = None) -> DataFrame:
    """`span, key, n, error` from combined states, by an expression over `span`; of all without one.

    Counts are at most `error` too high. Every key with more than twice that many rows is listed.
    """
    combined = states.groupBy((F.lit("all") if by is None else by).alias("span")).agg(
        F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(state, {int(tracked)})").alias("state")
    )
    listed = combined.select("span", "rows", F.expr(f"inline(approx_top_k_estimate(state, {int(tracked)}))"))
    return listed.select("span", F.col("item").alias("key"), F.col("count").alias("n"), (F.col("rows") * top_key_error(tracked)).alias("error"))


def distinct_routes(rows: DataFrame) -> DataFrame:
    routes = rows.select("origin", "destination").na.drop()
    return routes.select(delay.route(F.col("origin"), F.col("destination")).alias("route")).distinct()


def route_edges(rows: DataFrame) -> DataFrame:
    """Directed edges weighted by total delay minutes."""
    complete = rows.select("origin", "destination", "delay_minutes").na.drop()
    return complete.groupBy("origin", "destination").agg(F.sum("delay_minutes").alias("weight"))


def hub_attribution(rows: DataFrame, carrier: Column) -> DataFrame:
    return rows.groupBy("origin", carrier.alias("carrier")).agg(
        F.count(F.lit(1)).alias("flight_count"), F.avg("delay_minutes").alias("avg_delay")
    )


def fairness(rows: DataFrame, carrier: Column, majors: list[str] = delay.MAJOR_CARRIERS) -> DataFrame:
    return rows.groupBy(delay.carrier_class(carrier, majors).alias("carrier_type")).agg(
        F.avg("delay_minutes").alias("mean_delay_minutes"), F.count(F.lit(1)).alias("sample_size")
    )
