"""One row per key, membership against known keys, and per-batch accounting.

All of these are grouped aggregates, so a key that holds a large share of the
rows shrinks to one row per task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_batch(rows: DataFrame, *keys: str) -> DataFrame:
    """An arbitrary row per key."""
    return rows.dropDuplicates(list(keys))


def keep_first(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The smallest row per key by `order` (all other columns by default), nulls first.

    Taking the minimum of a struct instead of numbering rows in a window lets
    each task reduce its rows first.
    """
    others = [name for name in rows.columns if name not in keys]
    order = order or others
    ranked = F.struct(*order, *[name for name in others if name not in order])
    return (
        rows.groupBy(*keys)
        .agg(F.min(ranked).alias("_first"))
        .select(*[F.col(name) if name in keys else F.col(f"_first.{name}") for name in rows.columns])
    )


def accepted_only(rows: DataFrame, accepted: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is among the accepted ones."""
    return rows.join(accepted.select(*keys).distinct(), list(keys), "left_semi")


def not_seen(rows: DataFrame, seen: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key has not been seen before."""
    return rows.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def batch_audit(rows: DataFrame, batch: Column, *keys: str) -> DataFrame:
    """Per batch: distinct ids, ids new in this batch, ids seen in an earlier one."""
    arrivals = rows.groupBy(batch.alias("batch"), *keys).agg(F.count(F.lit(1)).alias("n"))
    totals = arrivals.groupBy("batch").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("total"))
    accepted = (
        arrivals.groupBy(*keys)
        .agg(F.min("batch").alias("batch"))
        .groupBy("batch")
        .agg(F.count(F.lit(1)).alias("accepted"))
    )
    return (
        totals.join(accepted, "batch", "left")
        .select(
            "batch",
            "rows",
            "total",
            F.coalesce("accepted", F.lit(0)).alias("accepted"),
            (F.col("total") - F.coalesce("accepted", F.lit(0))).alias("dupes"),
        )
    )
