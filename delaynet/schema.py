"""Column layouts shared by sources, operators and streams."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

FLIGHT_SCHEMA = StructType(
    [
        StructField("flight_id", StringType()),
        StructField("tail_number", StringType()),
        StructField("flight_number", IntegerType()),
        StructField("origin", StringType()),
        StructField("destination", StringType()),
        StructField("scheduled_departure", StringType()),
        StructField("delay_minutes", IntegerType()),
        StructField("delay_cause", StringType()),
    ]
)

FLIGHT_COLUMNS = FLIGHT_SCHEMA.fieldNames()

# Delay-cause columns of the raw file, in the order in which ties
# are resolved, with the label each one stands for.
CAUSE_LABELS = {
    "CARRIER_DELAY": "carrier",
    "WEATHER_DELAY": "weather",
    "NAS_DELAY": "nas",
    "SECURITY_DELAY": "security",
    "LATE_AIRCRAFT_DELAY": "late_aircraft",
}
NO_CAUSE = "on_time_or_no_cause"

# The columns read by name from a raw on-time file.
RAW_COLUMNS = [
    "YEAR",
    "MONTH",
    "DAY_OF_MONTH",
    "OP_UNIQUE_CARRIER",
    "OP_CARRIER_FL_NUM",
    "ORIGIN",
    "DEST",
    "CRS_DEP_TIME",
    "DEP_DELAY",
    *CAUSE_LABELS,
]

# Messages as a broker hands them over: opaque key and value.
MESSAGE_DDL = "key STRING, value BINARY"
