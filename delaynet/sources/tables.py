"""Input tables, and the flight and raw-record views derived from them.

FIXTURES.md describes the mapping. A view joins only the tables that the asked
columns need, so a query over routes never shuffles the part table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaynet.schema import FLIGHT_COLUMNS, RAW_COLUMNS

_CAUSE_BY_REST = ["carrier", "weather", "nas", "security", "late_aircraft"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tables read by fewer tasks than this hold a couple of gigabytes at most.
FEW_TASKS = 16


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a small table handed to all cores.

    A file of one row group is scanned by a single task, which then does all the
    work up to the next shuffle. Larger tables come with enough tasks of their
    own and are returned as they are, without a shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= min(cores, FEW_TASKS):
        return rows
    return rows.repartition(cores, *keys)


def _ship_day() -> Column:
    return F.date_format("l_shipdate", "yyyy-MM-dd")


def _from_line(name: str) -> Column:
    """Flight columns that a lineitem row holds by itself."""
    if name == "tail_number":
        return F.col("l_suppkey").cast("string")
    if name == "flight_number":
        return F.col("l_linenumber")
    if name == "scheduled_departure":
        hour = ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 24).cast("string")
        return F.concat(_ship_day(), F.lit("T"), F.lpad(hour, 2, "0"), F.lit(":00:00"))
    if name == "delay_minutes":
        return F.greatest(F.lit(0.0), F.col("l_quantity") * 5 - 60).cast("int")
    if name == "delay_cause":
        cause = F.when(F.col("l_quantity") <= 12, F.lit("on_time_or_no_cause"))
        for rest, label in enumerate(_CAUSE_BY_REST):
            cause = cause.when(F.col("l_partkey") % 5 == rest, F.lit(label))
        return cause
    return F.col(name)


def flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Flight rows with the asked columns (all by default)."""
    columns = columns or tuple(FLIGHT_COLUMNS)
    whole_id = "flight_id" in columns
    rows = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")

    # Dimension keys first, names last: order and customer meet before the far
    # larger lineitem joins them, and the 25 nation names are looked up at the end.
    if whole_id or "origin" in columns:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    if whole_id or "destination" in columns:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        rows = rows.join(orders.select("o_orderkey", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    if whole_id:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
    for name, key in (("origin", "s_nationkey"), ("destination", "c_nationkey")):
        if key in rows.columns:
            nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))
            rows = rows.join(nation, key)
    if whole_id:
        parts = ("origin", "destination", "p_brand", F.col("l_linenumber").cast("string"), _ship_day())
        rows = rows.withColumn("flight_id", F.concat_ws("|", *parts, F.col("l_orderkey").cast("string")))
    return rows.select(*[_from_line(name).alias(name) for name in columns])


def region_of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("airport"), F.col("r_name").alias("region")
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row as a raw string record, including the awkward spellings
    real files have: padding, blanks, `nan`, decimals, impossible times."""
    c = F.col
    line = c("l_linenumber")
    hhmm = ((c("l_partkey") * 37 + line * 13) % 2600).cast("string")
    year = F.date_format("l_shipdate", "yyyy")
    delay = F.concat((c("l_quantity").cast("int") - 10).cast("string"), F.lit(".5"))
    values = {
        "YEAR": F.when(line == 3, F.concat(year, F.lit(".0"))).otherwise(year),
        "MONTH": F.date_format("l_shipdate", "M"),
        "DAY_OF_MONTH": F.date_format("l_shipdate", "d"),
        "OP_UNIQUE_CARRIER": F.concat("l_returnflag", "l_linestatus"),
        "OP_CARRIER_FL_NUM": F.when(line == 1, F.lit(""))
        .when(line == 2, F.lit("NaN"))
        .otherwise(F.concat(c("l_orderkey").cast("string"), F.lit(".9"))),
        "ORIGIN": F.concat(F.lit("  S"), c("l_suppkey").cast("string"), F.lit(" ")),
        "DEST": F.when(c("l_tax") == 0, F.lit("")).otherwise(F.concat(F.lit("L"), line.cast("string"))),
        "CRS_DEP_TIME": F.when(line == 4, F.lit(""))
        .when(line == 5, F.concat(hhmm, F.lit(".0")))
        .when(line == 6, F.lit("2400"))
        .when((line == 7) & (c("l_discount") == 0), F.lit("x12"))
        .otherwise(hhmm),
        "DEP_DELAY": F.when(line == 2, F.lit("")).when(line == 3, F.lit("NaN")).otherwise(delay),
        "CARRIER_DELAY": F.round(c("l_discount") * 100).cast("int").cast("string"),
        "WEATHER_DELAY": F.round(c("l_tax") * 100).cast("int").cast("string"),
        "NAS_DELAY": F.concat(line.cast("string"), F.lit(".0")),
        "SECURITY_DELAY": F.lit(""),
        "LATE_AIRCRAFT_DELAY": F.when(c("l_returnflag") == "R", F.lit("nan")).otherwise(F.lit("5")),
    }
    rows = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    return rows.select(*[values[name].alias(name) for name in RAW_COLUMNS])
