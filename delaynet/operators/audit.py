"""Data quality, throughput windows, tiers and the hub scorecard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaynet.session import materialize


def data_quality(rows: DataFrame, key: str, timestamp: str, text_columns: list[str], as_of: Column) -> DataFrame:
    """Totals, missing values, duplicates, time range and freshness in one scan.

    Rows are first reduced per key, which yields the distinct count without a
    second pass; all other measures add up from there.
    """
    columns = rows.columns
    any_null = F.lit(False)
    for name in columns:
        any_null = any_null | F.col(name).isNull()
    per_key = rows.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(any_null, 1)).alias("incomplete"),
        F.sum(sum((F.col(name).isNull().cast("int") for name in columns), F.lit(0))).alias("nulls"),
        F.sum(sum(((F.col(name) == "").cast("int") for name in text_columns), F.lit(0))).alias("blanks"),
        F.min(timestamp).alias("first_ts"),
        F.max(timestamp).alias("last_ts"),
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("_key").alias("distinct_keys"),
        F.coalesce(F.sum("incomplete"), F.lit(0)).alias("incomplete_rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_values"),
        F.coalesce(F.sum("blanks"), F.lit(0)).alias("blank_values"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )
    cells = F.col("total_rows") * len(columns)
    return totals.select(
        "total_rows",
        "distinct_keys",
        (F.try_divide(F.col("total_rows") - F.col("incomplete_rows"), "total_rows") * 100).alias("compliance_pct"),
        (F.try_divide("null_values", cells) * 100).alias("null_density_pct"),
        "blank_values",
        (F.try_divide(F.col("total_rows") - F.col("distinct_keys"), "total_rows") * 100).alias("duplicate_pct"),
        F.col("first_ts").cast("string").alias("first_ts"),
        F.col("last_ts").cast("string").alias("last_ts"),
        F.timestamp_diff("SECOND", "last_ts", as_of).alias("freshness_seconds"),
    )


BINS = 1024  # equal parts that a range of values is cut into
FEW_VALUES = 4096  # distinct values that are sorted at once


def windowed_percentiles(counted: DataFrame, group: str, value: str, percents: list[int] | tuple[int, ...], n: str = "n") -> DataFrame:
    """Exact discrete percentiles per group as columns p<percent>, from a (group, value, n) relation.

    The range of a group's values is cut into equal bins; counts per bin tell which
    one holds a wanted position, and its own range is cut again as long as it holds
    many values. So a task sorts at most BINS bins or FEW_VALUES values of a group,
    however many rows or values it has, and wherever they crowd. Values that are null
    or not finite have no place in the order. The relation is read a few times, so pass a written one.
    """
    number = F.col(value).cast("double")
    rows = counted.filter(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf"))).select(
        F.col(group).alias("_group"), F.col(value).alias("_value"), F.col(n).alias("_n")
    )
    ranges = rows.groupBy("_group").agg(
        F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_values")
    )
    state = ranges.withColumn("_percent", F.explode(F.lit(list(percents)))).select(
        "_group", "_percent", F.greatest(F.lit(1), F.ceil(F.col("_total") * F.col("_percent") / 100)).alias("_position"),
        "_low", "_high", F.lit(0).cast("bigint").alias("_below"), "_values",
    )
    state = materialize(state, "ranges")
    key = ["_group", "_percent"]

    def inside() -> DataFrame:
        return rows.join(state, "_group").filter((F.col("_value") >= F.col("_low")) & (F.col("_value") <= F.col("_high")))

    while (state.agg(F.max("_values")).first()[0] or 0) > FEW_VALUES:
        share = (F.col("_value") - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0))
        part = F.least(F.lit(BINS - 1), F.floor(F.coalesce(share, F.lit(0.0)) * BINS))
        bins = inside().groupBy(*key, part.alias("_bin")).agg(
            F.sum("_n").alias("_in_bin"), F.min("_value").alias("_low"), F.max("_value").alias("_high"),
            F.count(F.lit(1)).alias("_values"), F.max("_position").alias("_position"), F.max("_below").alias("_below"),
        )
        running = F.sum("_in_bin").over(Window.partitionBy(*key).orderBy("_bin"))
        placed = bins.withColumn("_below", F.col("_below") + running - F.col("_in_bin"))
        held = (F.col("_position") > F.col("_below")) & (F.col("_position") <= F.col("_below") + F.col("_in_bin"))
        state = materialize(placed.filter(held).select(*key, "_position", "_low", "_high", "_below", "_values"), "ranges")

    running = F.sum("_n").over(Window.partitionBy(*key).orderBy("_value"))
    resolved = inside().withColumn("_upto", F.col("_below") + running)
    held = (F.col("_position") <= F.col("_upto")) & (F.col("_position") > F.col("_upto") - F.col("_n"))
    return resolved.filter(held).groupBy(F.col("_group").alias(group)).agg(
        *[F.max(F.when(F.col("_percent") == p, F.col("_value"))).alias(f"p{p}") for p in percents]
    )


def throughput_windows(rows: DataFrame, timestamp: str, value: str, width: str = "1 day", percents: tuple[int, ...] = (50, 99)) -> DataFrame:
    """Per time window: rows, rows per second, and percentiles of `value`.

    Rows are counted per window and value once; volumes and percentiles both come
    from the written counts.
    """
    placed = rows.select(F.window(timestamp, width).alias("w"), F.col(value).alias("value"))
    counted = placed.groupBy(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "value").agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted, "counted")
    seconds = F.timestamp_diff("SECOND", "window_start", "window_end")
    volume = counted.groupBy("window_start", "window_end").agg(F.sum("n").alias("records"))
    shape = windowed_percentiles(counted, "window_start", "value", percents)
    return (
        volume.withColumn("records_per_sec", F.col("records") / seconds)
        .drop("window_end")
        .join(shape, "window_start", "left")
    )


RANK_ERROR = 0.0133  # of a KLL sketch of the default size, at 99 % confidence for a single quantile


def quantile_sketches(rows: DataFrame, timestamp: str, value: str, width: str = "1 day") -> DataFrame:
    """`window_start, records, sketch`: one KLL sketch of `value` for each time window, to be stored and merged.

    One pass over the rows, a few kilobytes a window whatever it holds. Values that are
    null or not finite are left out, and windows without others do not appear.
    """
    number = F.col(value).cast("double")
    placed = rows.select(F.window(timestamp, width)["start"].alias("window_start"), number.alias("value"))
    usable = placed.filter(F.col("window_start").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")))
    return usable.groupBy("window_start").agg(F.count(F.lit(1)).alias("records"), F.kll_sketch_agg_double("value").alias("sketch"))


def sketched_percentiles(sketches: DataFrame, percents: tuple[int, ...] = (50, 99), by: Column | None = None) -> DataFrame:
    """`span, records, p<percent>`: approximate percentiles of merged windows, by an expression over `window_start`; of all without one."""
    merged = sketches.groupBy((F.lit("all") if by is None else by).alias("span")).agg(
        F.sum("records").alias("records"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    return merged.select("span", "records", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p / 100)).alias(f"p{p}") for p in percents])


def tier_summary(rows: DataFrame, timestamp: str, tiers: list[int]) -> DataFrame:
    """Volume of the first `tier` days of the data, and growth from tier to tier."""
    start = rows.agg(F.to_date(F.min(timestamp))).scalar()
    volume = (
        rows.select(F.date_diff(F.to_date(timestamp), start).alias("day"))
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("tier", F.explode(F.lit(tiers)))
        .filter(F.col("day") < F.col("tier"))
        .groupBy("tier")
        .agg(F.sum("n").alias("records"))
    )
    # one row per tier is left here
    before = Window.orderBy("tier")
    return volume.select(
        "tier",
        "records",
        (F.col("records") / (F.col("tier") * F.lit(86400.0))).alias("records_per_sec"),
        F.try_divide("records", F.lag("records").over(before)).alias("growth"),
    )


def hub_scorecard(ranks: DataFrame, volumes: DataFrame) -> DataFrame:
    """Influence against volume per hub.

    `amplification` is the hub's share of all rank divided by its share of all
    flights; hubs above 1 matter more than their traffic suggests.
    """
    joined = ranks.join(volumes, "airport", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    def total(measure: Column) -> Column:
        return joined.agg(measure).scalar()

    relative = F.col("pagerank") / total(F.max("pagerank"))
    rank_share = F.col("pagerank") / total(F.sum("pagerank"))
    return joined.select(
        "airport",
        relative.alias("relative_rank"),
        F.when(relative >= 0.95, F.lit("CRITICAL"))
        .when(relative >= 0.85, F.lit("HIGH"))
        .otherwise(F.lit("MODERATE"))
        .alias("band"),
        F.try_divide(rank_share, F.col("n") / total(F.sum("n"))).alias("amplification"),
    )
