"""Null handling, sampling and bounded row picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.functions.hashing import hash_bucket, hash_int


def drop_unrouted(rows: DataFrame) -> DataFrame:
    """Rows with both airports; blank codes pass, as only nulls mean missing."""
    return rows.na.drop(subset=["origin", "destination"])


def drop_incomplete(rows: DataFrame) -> DataFrame:
    return rows.na.drop(subset=["origin", "destination", "delay_minutes"])


def fill_cause(rows: DataFrame, label: str = "UNKNOWN") -> DataFrame:
    return rows.withColumn("delay_cause", F.coalesce(F.col("delay_cause"), F.lit(label)))


def clean_rows(rows: DataFrame) -> DataFrame:
    return fill_cause(drop_incomplete(rows))


def bernoulli_sample(rows: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    return rows.sample(fraction=fraction, seed=seed)


def hash_sample(rows: DataFrame, key: Column, per_mille: int = 100, method: str = "md5") -> DataFrame:
    """Sample decided by the key alone, so it is the same for any partitioning."""
    return rows.filter(hash_bucket(key, 0, 1000, method) < per_mille)


def first_n(rows: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def uniform_n(rows: DataFrame, n: int, key: Column | None = None, seed: int | None = None) -> DataFrame:
    """Exactly `n` rows (or all, if fewer), each set of rows equally likely.

    Only the `n` best-ranked rows of a task leave it. With a unique `key` the
    pick is repeatable; otherwise it is drawn afresh.
    """
    if key is None:
        draw = F.rand(seed)
        return rows.withColumn("_draw", draw).orderBy("_draw").limit(n).drop("_draw")
    return rows.orderBy(hash_int(key, 0), key).limit(n)
