import pytest
from pyspark.sql import functions as F

from delaynet.functions import delay, parsing
from delaynet.schema import CAUSE_LABELS, RAW_COLUMNS

BASE = {
    "YEAR": "2024", "MONTH": "2", "DAY_OF_MONTH": "28", "OP_UNIQUE_CARRIER": "AA", "OP_CARRIER_FL_NUM": "12",
    "ORIGIN": "ATL", "DEST": "ORD", "CRS_DEP_TIME": "659", "DEP_DELAY": "0", **{name: "0" for name in CAUSE_LABELS},
}


def normalized(spark, *changes):
    rows = [tuple({**BASE, **change}[name] for name in RAW_COLUMNS) for change in changes]
    raw = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in RAW_COLUMNS)).coalesce(1)
    return parsing.normalize(raw).collect()


TIMES = [
    ("659", "2024-02-28T06:59:00", "659"), ("0659", "2024-02-28T06:59:00", "659"), ("659.0", "2024-02-28T06:59:00", "659"),
    ("5", "2024-02-28T00:05:00", "5"), ("", "2024-02-28T00:00:00", ""), (" ", "2024-02-28T00:00:00", ""),
    ("2400", "2024-02-29T00:00:00", "2400"), ("2510", "2024-02-29T00:10:00", "2510"), ("2565", "2024-02-29T00:00:00", "2565"),
    ("65", None, "65"), ("1275", None, "1275"), ("-5", None, "-5"), ("nan", None, None), ("x12", None, None),
]


def test_departure_times(spark):
    rows = normalized(spark, *[{"CRS_DEP_TIME": text} for text, _, _ in TIMES])
    for row, (text, iso, shown) in zip(rows, TIMES):
        assert row.scheduled_departure == iso, text
        assert row.rejected == (iso is None), text
        assert row.flight_id == (None if shown is None else f"ATL|ORD|AA|12|2024-2-28|{shown}"), text


@pytest.mark.parametrize(
    "column, cases",
    [
        ("delay_minutes", [("2.5", 2), ("3.5", 4), ("-7", 0), ("", 0), ("NaN", 0), ("1e2", 100), (" 7 ", 7)]),
        ("flight_number", [("", 0), ("12.9", 12), ("-3.9", -3), ("nan", 0)]),
    ],
)
def test_numbers(spark, column, cases):
    source = {"delay_minutes": "DEP_DELAY", "flight_number": "OP_CARRIER_FL_NUM"}[column]
    rows = normalized(spark, *[{source: text} for text, _ in cases])
    assert [row[column] for row in rows] == [value for _, value in cases]
    assert not any(row.rejected for row in rows)


def test_junk_numbers_are_rejected(spark):
    junk = ["abc", "1d", "1f", "Infinity", "0x1p3", "--1", "1 2"]
    rows = normalized(spark, *[{"DEP_DELAY": text} for text in junk])
    assert all(row.rejected and row.delay_minutes == 0 for row in rows)


def test_bad_dates(spark):
    rows = normalized(spark, {"MONTH": "13"}, {"DAY_OF_MONTH": "30"}, {"YEAR": ""}, {"YEAR": "2024.0"})
    assert [row.rejected for row in rows] == [True, True, True, False]
    assert rows[3].flight_id == "ATL|ORD|AA|12|2024.0-2-28|659"


def test_causes(spark):
    names = list(CAUSE_LABELS)

    def cause(*values):
        return dict(zip(names, values))

    cases = [
        (cause("5", "5", "0", "0", "0"), "carrier"), (cause("0", "0", "0", "0", "0"), "on_time_or_no_cause"),
        (cause("", "", "", "", ""), "on_time_or_no_cause"), (cause("-1", "-2", "-1", "-3", "-4"), "on_time_or_no_cause"),
        (cause("nan", "1", "3", "", "3"), "nas"), (cause("", "", "", "", "0.5"), "late_aircraft"),
    ]
    rows = normalized(spark, *[change for change, _ in cases])
    assert [row.delay_cause for row in rows] == [label for _, label in cases]


def test_trimming(spark):
    row = normalized(spark, {"ORIGIN": "\tATL ", "DEST": None, "OP_UNIQUE_CARRIER": " DL\n"})[0]
    assert (row.origin, row.destination, row.carrier, row.tail_number) == ("ATL", "", "DL", "")


def test_bands_and_bins(spark):
    rows = spark.createDataFrame(
        [("2024-01-01T03:59:00", 0, "nas"), ("2024-01-01T20:00:00", 14, None), (None, 15, "nas"), ("bad", None, "nas")],
        "t string, d int, cause string",
    ).coalesce(1)
    hour = delay.hour_of_day(F.col("t"))
    got = rows.select(
        hour.alias("h"), delay.time_block(hour).alias("b"), delay.time_block(hour, strict=True).alias("s"),
        delay.delay_bin(F.col("d")).alias("bin"), delay.delay_token(F.col("d"), F.col("cause")).alias("token"),
    ).collect()
    assert [tuple(row) for row in got] == [
        (3, "Late Night (00-04)", "Late Night (00-04)", "0-15 min", "b0|nas"),
        (20, "Night (20-24)", "Night (20-24)", "0-15 min", None),
        (None, "Night (20-24)", None, "15-30 min", "b15|nas"),
        (None, "Night (20-24)", None, None, None),
    ]


def test_carrier(spark):
    rows = spark.createDataFrame([("A|B|DL|1",), ("A|B",), (None,)], "id string").coalesce(1)
    got = rows.select(delay.carrier_of(F.col("id")).alias("c"), delay.carrier_class(delay.carrier_of(F.col("id"))).alias("k"))
    assert [tuple(row) for row in got.collect()] == [("DL", "Major/Legacy"), (None, "Regional/Low-Cost"), (None, "Regional/Low-Cost")]
