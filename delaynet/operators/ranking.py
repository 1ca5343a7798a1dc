"""Comparison of a computed ranking with a given one.

Rankings enter as (key, score) relations. They are cut to the asked length
before positions are assigned, so numbering never sees more than that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(scores: DataFrame, key: str, score: str, limit: int) -> DataFrame:
    """(rank, key) of the `limit` highest scores, ties by key."""
    top = scores.select(F.col(key).alias("key"), F.col(score).alias("score")).orderBy(F.desc("score"), "key").limit(limit)
    return top.select(F.row_number().over(Window.orderBy(F.desc("score"), "key")).alias("rank"), "key")


def side_by_side(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    left, right = ours.withColumnRenamed("key", "ours"), theirs.withColumnRenamed("key", "theirs")
    return left.join(right, "rank", "full").select(
        "rank", F.coalesce("ours", F.lit("N/A")).alias("ours"), F.coalesce("theirs", F.lit("N/A")).alias("theirs")
    )


def _shared(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Keys of both rankings with the position from which a top-K holds them."""
    left, right = ours.withColumnRenamed("rank", "ours"), theirs.withColumnRenamed("rank", "theirs")
    return left.join(right, "key").select("key", F.greatest("ours", "theirs").alias("from_k"))


def ranking_overlap(ours: DataFrame, theirs: DataFrame, k: int = 20, verdict_at: float = 70.0) -> DataFrame:
    """Share of the `k` places held by keys that both rankings list."""
    listed = _shared(ours.filter(F.col("rank") <= k), theirs.filter(F.col("rank") <= k))
    counted = listed.agg(F.count(F.lit(1)).alias("common"))
    percent = F.col("common") / F.lit(float(k)) * 100
    return counted.select(
        "common",
        percent.alias("overlap_pct"),
        F.when(percent >= verdict_at, F.lit("validated")).otherwise(F.lit("differs")).alias("verdict"),
    )


def precision_at_k(ours: DataFrame, theirs: DataFrame, k: int = 20) -> DataFrame:
    """Overlap at min(length of ours, k); null for an empty ranking."""
    length = ours.agg(F.count(F.lit(1))).scalar()
    counted = _shared(ours, theirs).agg(
        F.count(F.when(F.col("from_k") <= F.least(length, F.lit(k)), 1)).alias("common")
    )
    effective = counted.withColumn("k", F.least(length, F.lit(k)))
    return effective.select("k", "common", (F.try_divide("common", "k") * 100).alias("precision_pct"))


def overlap_curve(ours: DataFrame, theirs: DataFrame, ks: list[int]) -> DataFrame:
    """Overlap for each K that our ranking is long enough for."""
    marks = ours.select("rank", "key").join(theirs.withColumnRenamed("rank", "their_rank"), "key", "left")
    steps = marks.withColumn("k", F.explode(F.lit(ks)))
    return (
        steps.groupBy("k")
        .agg(
            F.max("rank").alias("length"),
            F.count(F.when((F.col("rank") <= F.col("k")) & (F.col("their_rank") <= F.col("k")), 1)).alias("common"),
        )
        .filter(F.col("length") >= F.col("k"))
        .select("k", "common", (F.col("common") / F.col("k") * 100).alias("overlap_pct"))
    )


def regional_overlap(
    ours: DataFrame, our_score: str, theirs: DataFrame, their_score: str, regions: DataFrame, k: int
) -> DataFrame:
    """Per region, the share of its `k` best airports that both scores agree on."""

    def best(scores: DataFrame, score: str) -> DataFrame:
        order = Window.partitionBy("region").orderBy(F.desc(score), "airport")
        placed = scores.join(regions, "airport").withColumn("place", F.row_number().over(order))
        return placed.filter(F.col("place") <= k).select("region", "airport")

    mine = best(ours, our_score)
    common = mine.join(best(theirs, their_score).withColumn("agreed", F.lit(1)), ["region", "airport"], "left")
    return common.groupBy("region").agg(
        (F.count("agreed") / F.count(F.lit(1)) * 100).alias("overlap_pct")
    ).select(F.concat(F.lit("region "), "region").alias("metric"), "overlap_pct")


def attach_coordinates(ranks: DataFrame, components: DataFrame, places: DataFrame) -> DataFrame:
    """Ranked airports with component and coordinates, unknown places at (0, 0)."""
    return (
        ranks.join(components, "airport")
        .join(places, "airport", "left")
        .withColumns({"lat": F.coalesce("lat", F.lit(0.0)), "lng": F.coalesce("lng", F.lit(0.0))})
    )


def mapped_only(exported: DataFrame) -> DataFrame:
    return exported.filter((F.col("lat") != 0) | (F.col("lng") != 0))
