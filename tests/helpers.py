"""Small literal inputs for the tests."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from decimal import Decimal

from gridtally.schemas import READING_SCHEMA

NOW = "2024-06-01 00:00:00"
TYPES = [(11, "01-1", "A"), (12, "02-1", "B"), (14, "04-1", None)]
BASE = datetime(2024, 3, 1)


def item_types(spark):
    return spark.createDataFrame(TYPES, "id int, code string, basic_code string")


def limits(spark, rows=()):
    return spark.createDataFrame(
        [(n, t, Decimal(m), Decimal(c)) for n, t, m, c in rows],
        "item_name string, type_id int, max_value decimal(31,10), coefficient decimal(10,4)",
    )


def reading(meter, when, value, param="01-1", status="0", building="B0", gate="G0"):
    if isinstance(when, datetime):
        when = when.strftime("%Y%m%d%H%M%S")
    return (building, gate, meter, param, "01", None, status, value, "kWh", when)


def readings(spark, rows):
    return spark.createDataFrame(rows, READING_SCHEMA)


def records(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")


def at(hour, minute=0):
    return BASE + timedelta(hours=hour, minutes=minute)


def hour_tuples(df):
    """(item, type, hour, value, real value, error) of every hour row, sorted."""
    rows = df.select("item_name", "type_id", "date_time", "value", "real_value", "error").collect()
    return sorted(
        (r.item_name, r.type_id, r.date_time, float(r.value), float(r.real_value), r.error)
        for r in rows
    )


def fold(rows, limit=10000.0, ratio=1.0, state=None):
    """Brute-force hourly consumption of one series: [(datetime, value)] in any order."""
    last, out = state, []
    for when, value in sorted(rows):
        hour, amount = when.replace(minute=0, second=0), value * ratio
        if last is None:
            last = (hour, amount)
            continue
        if hour - last[0] < timedelta(hours=1):
            continue
        if hour - last[0] == timedelta(hours=1):
            delta = amount - last[1]
            error = 0 if 0 <= delta < limit else 2
            out.append((last[0], max(delta, 0.0), amount, error))
        last = (hour, amount)
    return out, last
