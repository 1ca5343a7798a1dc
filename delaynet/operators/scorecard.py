"""Measured accuracy and memory of the sketches next to the exact answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.functions.delay import pct_error
from delaynet.operators import bloom, cms, hll
from delaynet.session import materialize


def hll_vs_exact(rows: DataFrame, item: Column, p: int = 12, method: str = "xxhash64") -> DataFrame:
    """Estimated and exact number of distinct items over the same rows."""
    # Written once, the distinct items serve the count and the sketch, which repeats do not change.
    items = materialize(rows.select(item.alias("item")).na.drop().distinct(), "items")
    estimated = hll.estimate(hll.registers(items, F.col("item"), p, method), p)
    exact = items.agg(F.count(F.lit(1)).alias("exact"))
    return exact.withColumn("estimate", estimated.scalar()).withColumn(
        "error_pct", pct_error(F.col("exact"), F.col("estimate"))
    )


def cms_vs_exact(counts: DataFrame, key: str, width: int = 1000, depth: int = 5, top: int = 5, method: str = "xxhash64") -> DataFrame:
    """Exact and estimated counts of the `top` keys of a (key, n) relation."""
    leaders = counts.orderBy(F.desc("n"), key).limit(top)
    sketch = cms.build(counts, key, "n", depth, width, method)
    estimates = cms.probe(sketch, leaders, key, depth, width, method)
    return leaders.join(estimates, key).select(
        key, F.col("n").alias("exact"), "estimate", (F.col("estimate") - F.col("n")).alias("error")
    )


def sketch_scorecard(
    counts: DataFrame, outsiders: DataFrame, key: str, p: int = 12, width: int = 1000, depth: int = 5,
    fp_rate: float = 0.01, method: str = "xxhash64",
) -> DataFrame:
    """Bytes and accuracy (percent) of the three sketches of one key column.

    `counts` is the exact (key, n) relation, `outsiders` keys that are not in
    it, on which the Bloom filter should answer no. The filter is sized by the
    number of keys.
    """
    distinct = hll_vs_exact(counts, F.col(key), p, method).select(
        F.lit("hyperloglog").alias("sketch"),
        F.lit(1 << p).cast("long").alias("bytes"),
        (F.lit(100.0) - F.col("error_pct")).alias("accuracy_pct"),
    )
    estimates = cms.probe(cms.build(counts, key, "n", depth, width, method), counts, key, depth, width, method)
    frequency = counts.join(estimates, key).agg(
        (F.lit(100.0) - F.avg(F.abs(F.col("estimate") - F.col("n")) / F.col("n")) * 100).alias("accuracy_pct")
    )
    frequency = frequency.select(
        F.lit("count_min").alias("sketch"), F.lit(width * depth * cms.COUNTER_BYTES).cast("long").alias("bytes"), "accuracy_pct"
    )
    m_bits, k_hashes = bloom.sized(counts.count(), fp_rate)
    bits = bloom.build(counts, F.col(key), m_bits, k_hashes, method)
    judged = bloom.might_contain(outsiders, F.col(key), bits, m_bits, k_hashes, method)
    membership = judged.agg((F.avg((~F.col("maybe_seen")).cast("int")) * 100).alias("accuracy_pct")).select(
        F.lit("bloom").alias("sketch"), F.lit(m_bits // 8).cast("long").alias("bytes"), "accuracy_pct"
    )
    return distinct.unionByName(frequency).unionByName(membership)
