"""From raw text readings to typed ones, and the split into good and bad records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions import compute_once, numbers, text, times
from gridtally.schemas import FUTURE_TOLERANCE_SECONDS


def typed_readings(readings: DataFrame, position: str | None = None) -> DataFrame:
    """Parsed time and register next to the key fields.

    ``position`` names the column of arrival order, which decides between readings of one
    meter at the same time. Without it the choice is arbitrary but always the same.
    """
    if position is None:
        pos = F.shiftrightunsigned(F.xxhash64("value"), 1)
    else:
        pos = F.col(position)
    raw = readings.select(
        "building_id", "gate_id", "meter_id", "param_id", F.trim("status").alias("status"),
        pos.cast("long").alias("pos"), "value", "ts_str",
    )
    return compute_once(raw, {
        "reading_ts": times.parse_time(F.col("ts_str")),
        "register": numbers.parse_register(F.col("value")),
    }).drop("value", "ts_str")


def clean_readings(
    readings: DataFrame,
    item_types: DataFrame,
    now: datetime | str | None = None,
    tolerance_seconds: int = FUTURE_TOLERANCE_SECONDS,
    position: str | None = None,
) -> DataFrame:
    """Complete, good, not-future readings of a known medium, one typed row each.

    The medium code is looked up in ``item_types`` (id, code, basic_code); readings with
    an unknown code drop out.
    """
    complete = (
        F.col("building_id").isNotNull() & F.col("gate_id").isNotNull()
        & F.col("meter_id").isNotNull() & F.col("param_id").isNotNull()
        & F.col("register").isNotNull()
    )
    media = item_types.select(
        F.col("code").alias("param_id"),
        F.col("id").cast("int").alias("type_id"),
        F.col("basic_code").alias("type"),
    )
    return (
        typed_readings(readings, position)
        .where(F.col("status") == "0")
        .where(complete & times.not_in_future(F.col("reading_ts"), now, tolerance_seconds))
        .join(media, "param_id")
        .select(
            text.item_name(F.col("building_id"), F.col("gate_id"), F.col("meter_id"))
            .alias("item_name"),
            "type_id", "type", "reading_ts",
            times.hour_of(F.col("reading_ts")).alias("hour"),
            "register", "status", "pos",
        )
    )


def flag_quarantine(readings: DataFrame, now: datetime | str | None = None) -> DataFrame:
    """Adds ``quarantined``; the two sides are filters over this one frame.

    A storable record has a parseable time that is not in the future and a plain number.
    """
    storable = times.is_valid_time(F.col("ts_str"), now) & numbers.is_valid_number(F.col("value"))
    return compute_once(readings, {"quarantined": ~storable})


def quarantine_split(
    readings: DataFrame, now: datetime | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) readings, all original columns kept."""
    flagged = flag_quarantine(readings, now)
    good = flagged.where(~F.col("quarantined")).drop("quarantined")
    bad = flagged.where("quarantined").drop("quarantined")
    return good, bad


def with_medium(hour_rows: DataFrame) -> DataFrame:
    """Adds ``medium``: ``elec`` for type A, ``other`` for everything else."""
    return hour_rows.withColumn(
        "medium",
        F.when(text.is_electric(F.col("type")), F.lit("elec")).otherwise(F.lit("other")),
    )


def route_by_medium(hour_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    electric = text.is_electric(F.col("type"))
    return hour_rows.where(electric), hour_rows.where(~electric)
