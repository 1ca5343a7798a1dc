"""HyperLogLog as a relation of (register, rho) rows.

Building is one grouped maximum: a task sends at most one row per register, so
neither hot items nor high cardinality make the shuffle grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.functions.hashing import HASH_BITS, hash_int

# Bias corrections for small register counts.
SMALL_ALPHA = {16: 0.673, 32: 0.697, 64: 0.709}


def _register_count(p: int) -> int:
    if not 4 <= p <= 20:
        raise ValueError("p must be in 4..20")
    return 1 << p


def _alpha(m: int) -> float:
    return SMALL_ALPHA.get(m, 0.7213 / (1 + 1.079 / m))


def registers(rows: DataFrame, item: Column, p: int = 10, method: str = "xxhash64", by: tuple[str, ...] = ()) -> DataFrame:
    """Sketch of `item`, or one sketch per value of the `by` columns."""
    m = _register_count(p)
    remaining_bits = HASH_BITS[method] - p
    hashed = rows.select(*by, hash_int(item, method=method).alias("h")).filter(F.col("h").isNotNull())
    rest = F.shiftright("h", p)
    rho = F.when(rest == 0, F.lit(remaining_bits + 1)).otherwise(remaining_bits + 1 - F.length(F.bin(rest)))
    return hashed.groupBy(*by, F.col("h").bitwiseAND(m - 1).alias("register")).agg(F.max(rho).alias("rho"))


def merge(*sketches: DataFrame) -> DataFrame:
    """One sketch of everything, from several sketches or from one kept `by` value."""
    merged = sketches[0].select("register", "rho")
    for sketch in sketches[1:]:
        merged = merged.unionByName(sketch.select("register", "rho"))
    return merged.groupBy("register").agg(F.max("rho").alias("rho"))


def estimate(sketch: DataFrame, p: int = 10) -> DataFrame:
    """One row with the estimated number of distinct items; empty sketches give 0."""
    m = _register_count(p)
    empty = F.lit(m) - F.count(F.lit(1))
    inverse_sum = F.coalesce(F.sum(F.pow(F.lit(2.0), -F.col("rho"))), F.lit(0.0)) + empty
    totals = sketch.agg(empty.alias("empty"), (F.lit(_alpha(m) * m * m) / inverse_sum).alias("raw"))
    linear = F.lit(float(m)) * F.log(F.lit(float(m)) / F.nullif("empty", F.lit(0)))
    small = (F.col("raw") <= 2.5 * m) & (F.col("empty") > 0)
    return totals.select(F.when(small, linear).otherwise(F.col("raw")).alias("estimate"))


def builtin_estimate(rows: DataFrame, item: Column, lg_k: int = 12) -> DataFrame:
    """The same question answered by Spark's own mergeable sketch."""
    return rows.agg(F.hll_sketch_estimate(F.hll_sketch_agg(item, F.lit(lg_k))).alias("estimate"))


def stored_sketches(rows: DataFrame, span: Column, item: Column, lg_k: int = 12) -> DataFrame:
    """`span, sketch`: one binary sketch for each span of time, to be written once and united at will.

    Spans without any item have an empty sketch; null items are not counted.
    """
    return rows.groupBy(span.alias("span")).agg(F.hll_sketch_agg(item, F.lit(lg_k)).alias("sketch"))


def united(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct items of each value of `by`, from stored sketches alone."""
    return sketches.groupBy(*by).agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimate"))


def stored_error(lg_k: int = 12) -> float:
    """Standard error of united sketches, as a share of the true number."""
    return 1.04 / 2 ** (lg_k / 2)
