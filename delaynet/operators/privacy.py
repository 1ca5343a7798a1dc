"""Noisy counts, privacy-budget sweeps, generalised rows and k-anonymous releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.functions import delay
from delaynet.functions.noise import noisy

QUASI_IDENTIFIERS = ["origin", "destination", "time_block", "delay_bin"]


def _check_budget(*epsilons: float) -> None:
    if min(epsilons) <= 0:
        raise ValueError(f"a privacy budget is positive, not {min(epsilons)}")


def noisy_counts(counts: DataFrame, epsilon: float, uniform: Column, sensitivity: float = 1.0, clamp: float | None = 0.0) -> DataFrame:
    """(key, n) counts with `noisy`, the released value, and its absolute error."""
    _check_budget(epsilon)
    released = counts.withColumn("noisy", noisy(F.col("n"), F.lit(float(epsilon)), sensitivity, uniform, clamp))
    return released.withColumn("abs_error", delay.abs_error(F.col("n"), F.col("noisy")))


def _trials(counts: DataFrame, epsilons: list[float], trials: int) -> DataFrame:
    """Every count once per budget and trial, generated in place."""
    _check_budget(*epsilons)
    return counts.withColumn("epsilon", F.explode(F.lit([float(e) for e in epsilons]))).withColumn(
        "trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1)))
    )


def epsilon_sweep(counts: DataFrame, epsilons: list[float], trials: int, uniform: Column, sensitivity: float = 1.0) -> DataFrame:
    """Mean absolute error of clamped releases per budget.

    `uniform` may use the columns `epsilon` and `trial`.
    """
    released = noisy(F.col("n"), F.col("epsilon"), sensitivity, uniform)
    return (
        _trials(counts, epsilons, trials)
        .groupBy("epsilon")
        .agg(F.avg(F.abs(released - F.col("n"))).alias("mae"))
    )


def leakage_audit(counts: DataFrame, epsilons: list[float], trials: int, uniform: Column, sensitivity: float = 1.0) -> DataFrame:
    """How well an observer of a key's release tells its count n from n - 1, by a threshold half way between.

    `overlap` is the share of draws where both worlds land above the threshold
    although only one of them should; `accuracy` is the share of right guesses.
    """
    # both worlds see the same draw, as the comparison is about the shift by one
    border = F.col("n") - 0.5
    with_record, without_record = (
        noisy(count, F.col("epsilon"), sensitivity, uniform, clamp=0.0) > border for count in (F.col("n"), F.col("n") - 1)
    )
    return (
        _trials(counts, epsilons, trials)
        .select("epsilon", with_record.alias("hit"), without_record.alias("false_alarm"))
        .groupBy("epsilon")
        .agg(
            F.avg((F.col("hit") & F.col("false_alarm")).cast("int")).alias("overlap"),
            F.avg((F.col("hit").cast("int") + (~F.col("false_alarm")).cast("int")) / 2).alias("accuracy"),
        )
    )


def generalize(rows: DataFrame, strict: bool = False) -> DataFrame:
    hour = delay.hour_of_day(F.col("scheduled_departure").cast("string"))
    return rows.select(
        "flight_id",
        "origin",
        "destination",
        delay.time_block(hour, strict).alias("time_block"),
        delay.delay_bin(F.col("delay_minutes")).alias("delay_bin"),
        "delay_cause",
    )


def k_anonymous(generalized: DataFrame, k: int, sensitive: str = "delay_cause") -> DataFrame:
    """The releasable table: one row per class and sensitive value, with its count.

    Without the identifier equal rows are interchangeable, so counts carry the
    whole release and no class ever has to be gathered row by row. Classes of
    fewer than `k` rows are left out.
    """
    values = generalized.groupBy(*QUASI_IDENTIFIERS, sensitive).agg(F.count(F.lit(1)).alias("n"))
    sizes = values.groupBy(*QUASI_IDENTIFIERS).agg(F.sum("n").alias("class_size")).filter(F.col("class_size") >= k)
    same = [F.col(f"v.{name}").eqNullSafe(F.col(f"s.{name}")) for name in QUASI_IDENTIFIERS]
    return values.alias("v").join(sizes.alias("s"), same).select("v.*", "s.class_size")


def anonymous_rows(released: DataFrame) -> DataFrame:
    """The release written out row by row, as many copies as counted."""
    return released.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("_copy", "n", "class_size")


def suppressed(generalized: DataFrame, k: int) -> DataFrame:
    """Rows and classes a release at `k` leaves out."""
    sizes = generalized.groupBy(*QUASI_IDENTIFIERS).agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < k
    return sizes.agg(
        F.count(F.lit(1)).alias("classes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.when(small, 1)).alias("suppressed_classes"),
        F.coalesce(F.sum(F.when(small, F.col("n"))), F.lit(0)).alias("suppressed_rows"),
    )
