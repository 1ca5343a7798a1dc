"""Count-Min sketch as a relation of (width, depth_row, bucket, n) rows.

A task sends at most depth x width rows. Sketches are linear, so adding a
pre-counted (key, n) relation equals adding its rows one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.functions.hashing import hash_int

COUNTER_BYTES = 4


def _cells(rows: DataFrame, key: Column, depth: int, widths: list[int], method: str) -> DataFrame:
    """Rows repeated per sketch cell they touch. Each row is hashed once per depth."""
    if depth <= 0 or min(widths) <= 0:
        raise ValueError(f"a sketch of {depth} rows by {min(widths)} counters holds nothing")
    hashes = rows.withColumn("_hashes", F.array(*[hash_int(key, i, method) for i in range(depth)]))
    cells = hashes.select(*rows.columns, F.posexplode("_hashes").alias("depth_row", "_hash"))
    return cells.withColumn("width", F.explode(F.lit(widths))).withColumn("bucket", F.pmod("_hash", "width")).drop("_hash")


def build(
    rows: DataFrame,
    key: str,
    weight: str | None = None,
    depth: int = 5,
    widths: int | list[int] = 2048,
    method: str = "xxhash64",
    precount: bool = False,
) -> DataFrame:
    """Sketch of `key`, each row counting 1 or `weight`.

    Tasks add up depth x width counters, so that is what they shuffle. With
    `precount` rows are counted per key first, which hashes every key once instead
    of every row, but shuffles the keys; it pays for few keys only.
    """
    widths = [widths] if isinstance(widths, int) else list(widths)
    amount = F.lit(1) if weight is None else F.col(weight)
    items = rows.select(F.col(key).alias("key"), amount.cast("long").alias("n")).filter(F.col("key").isNotNull())
    if weight is not None:
        # negative counts would break the "never below the true count" guarantee
        negative = F.raise_error(F.lit("count must be non-negative")).cast("long")
        items = items.withColumn("n", F.when(F.col("n") >= 0, F.col("n")).otherwise(negative))
    elif precount:
        items = items.groupBy("key").agg(F.sum("n").alias("n"))
    return (
        _cells(items, F.col("key"), depth, widths, method)
        .groupBy("width", "depth_row", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def merge(*sketches: DataFrame) -> DataFrame:
    merged = sketches[0]
    for sketch in sketches[1:]:
        merged = merged.unionByName(sketch)
    return merged.groupBy("width", "depth_row", "bucket").agg(F.sum("n").alias("n"))


def probe(sketch: DataFrame, keys: DataFrame, key: str, depth: int = 5, widths: int | list[int] = 2048, method: str = "xxhash64") -> DataFrame:
    """`keys` with `width` and the estimate: the smallest counter of all depth rows."""
    widths = [widths] if isinstance(widths, int) else list(widths)
    asked = _cells(keys.select(F.col(key).alias("key")).distinct(), F.col("key"), depth, widths, method)
    counters = sketch.withColumnRenamed("n", "_counter")
    return (
        asked.join(counters, ["width", "depth_row", "bucket"], "left")
        .groupBy(F.col("key").alias(key), "width")
        .agg(F.min(F.coalesce("_counter", F.lit(0))).alias("estimate"))
    )


def memory_bytes(width: Column, depth: int = 5) -> Column:
    return width * (depth * COUNTER_BYTES)


def width_sweep(counts: DataFrame, key: str, widths: list[int], depth: int = 5, top: int = 100, method: str = "xxhash64") -> DataFrame:
    """Mean absolute error over the `top` most frequent keys, per sketch width.

    `counts` is a (key, n) relation; all widths are built in one grouped pass.
    """
    studied = counts.orderBy(F.desc("n"), key).limit(top)
    estimates = probe(build(counts, key, "n", depth, widths, method), studied, key, depth, widths, method)
    return (
        estimates.join(studied, key)
        .groupBy("width")
        .agg(F.avg(F.abs(F.col("estimate") - F.col("n"))).alias("mae"))
        .select("width", memory_bytes(F.col("width"), depth).alias("bytes"), "mae")
        .withColumn("kilobytes", F.col("bytes") / 1024.0)
    )
