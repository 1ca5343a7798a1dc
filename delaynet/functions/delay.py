"""Column expressions over flight rows: routes, tokens, bands and bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the four-hour bands of a day.
TIME_BLOCKS = {
    4: "Late Night (00-04)",
    8: "Early Morning (04-08)",
    12: "Morning (08-12)",
    16: "Afternoon (12-16)",
    20: "Evening (16-20)",
    24: "Night (20-24)",
}

# Carriers of the first class and the two class names.
MAJOR_CARRIERS = ["AA", "DL", "UA", "WN", "AS", "B6"]
MAJOR_CLASS = "Major/Legacy"
OTHER_CLASS = "Regional/Low-Cost"


def route(origin: Column, destination: Column) -> Column:
    return F.concat_ws("-", origin, destination)


def group_id(*columns: Column) -> Column:
    return F.concat_ws("|", *[column.cast("string") for column in columns])


def floor_to(value: Column, step: int) -> Column:
    return (F.floor(value / step) * step).cast("int")


def delay_token(minutes: Column, cause: Column, bucket: int = 5) -> Column:
    """`b<lower bound>|<cause>`; null when either part is missing."""
    return F.concat(F.lit("b"), floor_to(minutes, bucket).cast("string"), F.lit("|"), cause)


def delay_tokens(minutes: Column, cause: Column, bucket: int = 5) -> Column:
    return F.array(delay_token(minutes, cause, bucket))


def hour_of_day(iso_text: Column) -> Column:
    return F.substring(iso_text, 12, 2).try_cast("int")


def time_block(hour: Column, strict: bool = False) -> Column:
    """Four-hour band; an unknown hour counts as night unless `strict`."""
    *bands, (_, last) = TIME_BLOCKS.items()
    block = F.when(hour < 0, F.lit(None).cast("string") if strict else F.lit(last))
    for upper, label in bands:
        block = block.when(hour < upper, F.lit(label))
    if strict:
        return block.when(hour < 24, F.lit(last))
    return block.otherwise(F.lit(last))


def delay_bin(minutes: Column, width: int = 15) -> Column:
    low = floor_to(minutes, width)
    return F.concat(low.cast("string"), F.lit("-"), (low + width).cast("string"), F.lit(" min"))


def carrier_of(flight_id: Column) -> Column:
    """Third `|`-separated part of an identifier, null when there are fewer."""
    return F.get(F.split(flight_id, r"\|"), F.lit(2))


def carrier_class(carrier: Column, majors: list[str] = MAJOR_CARRIERS) -> Column:
    return F.when(carrier.isin(majors), F.lit(MAJOR_CLASS)).otherwise(F.lit(OTHER_CLASS))


def abs_error(exact: Column, estimate: Column) -> Column:
    return F.abs(exact - estimate)


def pct_error(exact: Column, estimate: Column) -> Column:
    return F.try_divide(F.abs(exact - estimate) * F.lit(100.0), exact)
