import math

import pytest
from pyspark.sql import functions as F

from delaynet.functions.noise import keyed_uniform, laplace, random_uniform
from delaynet.operators import privacy


def counts(spark, n=40, size=5):
    return spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(size).alias("n"))


def test_noise_is_laplace(spark):
    draws = spark.range(40_000).select(laplace(3.0, keyed_uniform(F.col("id"))).alias("x"))
    mean, size, above = draws.agg(F.avg("x"), F.avg(F.abs("x")), F.avg((F.col("x") > 3 * math.log(2)).cast("int"))).first()
    assert abs(mean) < 0.1 and abs(size - 3.0) < 0.1 and abs(above - 0.25) < 0.01


def test_random_draws_stay_inside(spark):
    low, high, kinds = spark.range(10_000).select(random_uniform().alias("u")).agg(F.min("u"), F.max("u"), F.countDistinct("u")).first()
    assert -0.5 < low < -0.45 and 0.45 < high < 0.5 and kinds > 9_000


@pytest.mark.parametrize("bad", [0, -1.0])
def test_parameters_are_checked(spark, bad):
    with pytest.raises(ValueError):
        privacy.noisy_counts(counts(spark), bad, F.lit(0.1))
    with pytest.raises(ValueError):
        privacy.epsilon_sweep(counts(spark), [1.0, bad], 2, F.lit(0.1))
    with pytest.raises(ValueError):
        laplace(bad, F.lit(0.1))


def test_release_is_clamped_unless_asked(spark):
    uniform = keyed_uniform(F.col("key"))
    clamped = privacy.noisy_counts(counts(spark, 200, 1), 0.1, uniform)
    assert clamped.agg(F.min("noisy")).first()[0] == 0.0
    assert privacy.noisy_counts(counts(spark, 200, 1), 0.1, uniform, clamp=None).agg(F.min("noisy")).first()[0] < 0


def test_sweep_and_leakage_match_theory(spark):
    epsilons = [0.1, 0.5, 1.0, 5.0]
    uniform = keyed_uniform(F.col("key"), F.col("trial"))
    for row in privacy.epsilon_sweep(counts(spark), epsilons, 500, uniform).collect():
        b = 1 / row.epsilon
        assert abs(row.mae - b * (1 - 0.5 * math.exp(-5 / b))) < 0.03 * b
    for row in privacy.leakage_audit(counts(spark), epsilons, 500, uniform).collect():
        assert abs(row.overlap - 0.5 * math.exp(-row.epsilon / 2)) < 0.02
        assert abs(row.accuracy - (1 - 0.5 * math.exp(-row.epsilon / 2))) < 0.02


def test_k_anonymity(spark):
    rows = spark.createDataFrame(
        [("1", "A", "B", "2024-01-01T01:00:00", 3, "nas"), ("2", "A", "B", "2024-01-01T02:00:00", 7, "nas"),
         ("3", "A", "B", "2024-01-01T03:00:00", 9, "weather"), ("4", "A", "B", "2024-01-01T05:00:00", 9, "nas"),
         ("5", None, "B", "2024-01-01T05:00:00", 9, "nas"), ("6", None, "B", "2024-01-01T05:00:00", 9, "nas"),
         ("7", None, "B", "2024-01-01T05:00:00", None, "nas")],
        "flight_id string, origin string, destination string, scheduled_departure string, delay_minutes int, delay_cause string",
    )
    general = privacy.generalize(rows)
    released = privacy.k_anonymous(general, 2)
    got = {(r.origin, r.time_block, r.delay_bin, r.delay_cause, r.n, r.class_size) for r in released.collect()}
    assert got == {
        ("A", "Late Night (00-04)", "0-15 min", "nas", 2, 3), ("A", "Late Night (00-04)", "0-15 min", "weather", 1, 3),
        (None, "Early Morning (04-08)", "0-15 min", "nas", 2, 2),
    }
    written = privacy.anonymous_rows(released)
    assert "flight_id" not in written.columns and written.count() == 5
    assert tuple(privacy.suppressed(general, 2).first()) == (4, 7, 2, 2)
