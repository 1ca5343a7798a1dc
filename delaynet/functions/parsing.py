"""Typed values from the string columns of a raw on-time file.

All functions take and return columns. Text that cannot be read becomes null
instead of failing the job; `rejected` in `normalize` marks such rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.schema import CAUSE_LABELS, NO_CAUSE

_WHITESPACE = " \t\r\n"


def stripped(text: Column) -> Column:
    return F.coalesce(F.btrim(text, F.lit(_WHITESPACE)), F.lit(""))


def is_blank(text: Column) -> Column:
    return F.lower(stripped(text)).isin("", "nan")


def parse_float(text: Column) -> Column:
    """Decimal number; null for blanks, `nan` and anything else.

    The cast alone would also take `1d`, `Infinity` and hexadecimal numbers.
    """
    text = stripped(text)
    decimal = F.right(text, F.lit(1)).rlike("[0-9.]") & ~F.lower(text).contains("x")
    return F.when(decimal, text.try_cast("double"))


def is_number(text: Column) -> Column:
    return parse_float(text).isNotNull()


def truncated(number: Column) -> Column:
    """Integer part, toward zero; null when it does not fit."""
    return number.try_cast("int")


def parse_int(text: Column) -> Column:
    return truncated(parse_float(text))


def date_of(year: Column, month: Column, day: Column) -> Column:
    """Date from whole numbers, null when there is no such day."""
    y, m, d = (part.cast("string") for part in (year, month, day))
    return F.concat(F.lpad(y, 4, "0"), F.lit("-"), m, F.lit("-"), d).try_cast("date")


def iso_departure(date: Column, hhmm: Column, blank: Column) -> Column:
    """ISO local time from a date and an HHMM number.

    A `blank` time means midnight. Hours of 24 and more move to the next day and
    keep only the minutes, where minutes past 59 count as 0. Other impossible
    times give null.
    """
    hour, minute = F.floor(hhmm / 100).cast("int"), hhmm % 100
    overflow = hour >= 24
    day = F.when(~blank & overflow, F.date_add(date, 1)).otherwise(date).cast("string")
    shown_hour = F.when(overflow, F.lit(0)).otherwise(hour)
    shown_minute = F.when(minute < 60, minute).when(overflow, F.lit(0))
    clock = F.when(blank, F.lit("00:00")).when(
        hhmm >= 0,
        F.concat(
            F.lpad(shown_hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(shown_minute.cast("string"), 2, "0")
        ),
    )
    return F.concat(day, F.lit("T"), clock, F.lit(":00"))


def departure_iso(year: Column, month: Column, day: Column, hhmm: Column) -> Column:
    date = date_of(parse_int(year), parse_int(month), parse_int(day))
    return iso_departure(date, parse_int(hhmm), stripped(hhmm) == "")


def clamped(minutes: Column) -> Column:
    """Half-even rounded minutes, missing and early departures as 0."""
    return F.greatest(F.lit(0), F.coalesce(truncated(F.bround(minutes, 0)), F.lit(0)))


def delay_minutes(delay: Column) -> Column:
    return clamped(parse_float(delay))


def largest_cause(values: dict[str, Column]) -> Column:
    """Label of the first value that is the largest, if that is positive."""
    top = F.greatest(*values.values())
    labels = [F.when((value == top) & (top > 0), F.lit(label)) for label, value in values.items()]
    return F.coalesce(*labels, F.lit(NO_CAUSE))


def dominant_cause() -> Column:
    return largest_cause({label: parse_float(F.col(name)) for name, label in CAUSE_LABELS.items()})


def flight_number(text: Column) -> Column:
    return F.coalesce(parse_int(text), F.lit(0))


def normalize(raw: DataFrame) -> DataFrame:
    """Flight rows from raw string rows, plus `carrier` and a `rejected` mark.

    Rejected rows had a number, date or time that could not be read. The id is
    `origin|dest|carrier|number|Y-M-D|HHMM`, its date parts as written in the
    file. Every field is read once, in a projection of its own.
    """
    texts = ["YEAR", "MONTH", "DAY_OF_MONTH", "CRS_DEP_TIME"]
    optional = ["OP_CARRIER_FL_NUM", "DEP_DELAY", *CAUSE_LABELS]
    # One expression reads all numbers. Written out per column, the generated
    # method would outgrow what the JVM is willing to compile.
    numbers = F.transform(F.array(*texts, *optional), parse_float)
    blanks = F.transform(F.array(*optional), is_blank)
    read = raw.select(
        stripped(F.col("ORIGIN")).alias("origin"),
        stripped(F.col("DEST")).alias("destination"),
        stripped(F.col("OP_UNIQUE_CARRIER")).alias("carrier"),
        *[stripped(F.col(name)).alias(f"{name}_text") for name in texts],
        numbers.alias("numbers"),
        blanks.alias("blanks"),
    )
    value = {name: F.col("numbers")[i] for i, name in enumerate([*texts, *optional])}
    unread = F.slice("numbers", len(texts) + 1, len(optional))
    fields = read.select(
        "origin",
        "destination",
        "carrier",
        *[f"{name}_text" for name in texts],
        *[truncated(value[name]).alias(name) for name in (*texts, "OP_CARRIER_FL_NUM")],
        *[value[name].alias(name) for name in ("DEP_DELAY", *CAUSE_LABELS)],
        F.exists(F.zip_with(unread, "blanks", lambda number, blank: number.isNull() & ~blank), lambda bad: bad).alias("junk"),
    )
    blank_time = F.col("CRS_DEP_TIME_text") == ""
    date = date_of(F.col("YEAR"), F.col("MONTH"), F.col("DAY_OF_MONTH"))
    number = F.coalesce("OP_CARRIER_FL_NUM", F.lit(0))
    written_date = F.concat(
        "YEAR_text", F.lit("-"), "MONTH_text", F.lit("-"), "DAY_OF_MONTH_text"
    )
    written_time = F.when(blank_time, F.lit("")).otherwise(F.col("CRS_DEP_TIME").cast("string"))
    bar = F.lit("|")
    rows = fields.select(
        F.concat(
            "origin", bar, "destination", bar, "carrier", bar, number.cast("string"), bar, written_date, bar, written_time
        ).alias("flight_id"),
        F.lit("").alias("tail_number"),
        number.alias("flight_number"),
        "origin",
        "destination",
        iso_departure(date, F.col("CRS_DEP_TIME"), blank_time).alias("scheduled_departure"),
        clamped(F.col("DEP_DELAY")).alias("delay_minutes"),
        largest_cause({label: F.col(name) for name, label in CAUSE_LABELS.items()}).alias("delay_cause"),
        "carrier",
        "junk",
    )
    return rows.withColumn("rejected", F.col("junk") | F.col("scheduled_departure").isNull()).drop("junk")
