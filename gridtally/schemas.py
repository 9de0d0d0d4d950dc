"""Column types shared by every table.

Registers and amounts stay exact decimals inside the library; ``as_double`` is the
last step before a result leaves it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ten positional fields of one raw reading, in record order.
READING_FIELDS = [
    "building_id", "gate_id", "meter_id", "param_id", "type",
    "name", "status", "value", "unit", "ts_str",
]

READING_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in READING_FIELDS])

REGISTER = T.DecimalType(20, 6)      # a parsed meter register
COEFFICIENT = T.DecimalType(10, 4)   # transformer ratio of an item
AMOUNT = T.DecimalType(31, 10)       # register x coefficient, and every difference of two
TOTAL = T.DecimalType(38, 10)        # sums of amounts

# Limits used where an item declares none.
DEFAULT_MAX_VALUE = 10000
DEFAULT_COEFFICIENT = 1
THIRD_PARTY_CEILING = 100000
FUTURE_TOLERANCE_SECONDS = 3600

SERIES_KEY = ["item_name", "type_id"]
HOUR_KEY = ["item_name", "type_id", "date_time"]
SUBENTRY_KEY = ["building_code", "data_time"]

HOUR_COLUMNS = [
    "item_name", "type_id", "date_time", "value", "real_value", "rate", "error", "type",
]
DAY_COLUMNS = [
    "item_name", "type_id", "date_time", "value", "real_value", "rate", "error",
    "work_time_value", "other_time_value", "type",
]
MONTH_COLUMNS = HOUR_COLUMNS

# Sub-entry column -> first three characters of its codes.
SUBENTRY_BUCKETS = {
    "electricity": "010",
    "electricity_a": "01A",
    "electricity_b": "01B",
    "electricity_c": "01C",
    "electricity_d": "01D",
}
SUBENTRY_COLUMNS = ["building_code", *SUBENTRY_BUCKETS, "rate", "data_time"]

HOUR_SCHEMA = T.StructType([
    T.StructField("item_name", T.StringType()),
    T.StructField("type_id", T.IntegerType()),
    T.StructField("date_time", T.TimestampType()),
    T.StructField("value", AMOUNT),
    T.StructField("real_value", AMOUNT),
    T.StructField("rate", AMOUNT),
    T.StructField("error", T.IntegerType()),
    T.StructField("type", T.StringType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("item_name", T.StringType()),
    T.StructField("type_id", T.IntegerType()),
    T.StructField("date_time", T.TimestampType()),
    T.StructField("real_value", AMOUNT),
    T.StructField("status", T.StringType()),
])

QUEUE_SCHEMA = T.StructType([
    T.StructField("build_code", T.StringType()),
    T.StructField("collector_code", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("type", T.IntegerType()),
])


def as_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double: the presentation form of a result table."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
