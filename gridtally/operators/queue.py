"""The queue of collectors whose hours need work (types: 0 own, 2 third party, 3 done)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions import compute_once, text, times
from gridtally.schemas import FUTURE_TOLERANCE_SECONDS, QUEUE_SCHEMA

OWN, THIRD_PARTY, DONE = 0, 2, 3
QUEUE_COLUMNS = QUEUE_SCHEMA.fieldNames()
QUEUE_KEY = ["build_code", "collector_code", "timestamp"]


def stamp(time: str) -> str:
    """First ten digits of a time: the form in which the queue stores hours."""
    return "".join(c for c in time if c.isdigit())[:10]


def data_access_events(
    readings: DataFrame,
    now: datetime | str | None = None,
    tolerance_seconds: int = FUTURE_TOLERANCE_SECONDS,
) -> DataFrame:
    """One row per collector and hour that any record with a valid time touched."""
    touched = readings.select("building_id", "gate_id", "ts_str")
    return (
        compute_once(touched, {"ts": times.parse_time(F.col("ts_str"))})
        .where(F.col("building_id").isNotNull() & F.col("gate_id").isNotNull())
        .where(times.not_in_future(F.col("ts"), now, tolerance_seconds))
        .select(
            F.col("building_id").alias("build_code"),
            F.col("gate_id").alias("collector_code"),
            times.hour_stamp(F.col("ts")).alias("timestamp"),
            F.lit(OWN).alias("type"),
        )
        .dropDuplicates()
    )


def events_of_hour_rows(hour_rows: DataFrame) -> DataFrame:
    """The backfill's rule: collectors of emitted hour rows, stamped with the processed hour."""
    name = F.col("item_name")
    return hour_rows.select(
        text.building_of(name).alias("build_code"),
        text.collector_of(name).alias("collector_code"),
        times.hour_stamp(F.col("date_time") + times.hours(1)).alias("timestamp"),
        F.lit(OWN).alias("type"),
    ).dropDuplicates()


def pending(queue: DataFrame, time: str) -> DataFrame:
    """Distinct own rows up to a time, oldest first."""
    return (
        queue.where((F.col("type") == OWN) & (F.col("timestamp") <= stamp(time)))
        .select(*QUEUE_KEY)
        .distinct()
        .orderBy("timestamp")
    )


def pending_third_party(queue: DataFrame, time: str) -> DataFrame:
    """Distinct third-party rows up to a time that are not done yet."""
    done = queue.where(F.col("type") == DONE).select(*QUEUE_KEY)
    return (
        queue.where((F.col("type") == THIRD_PARTY) & (F.col("timestamp") <= stamp(time)))
        .select(*QUEUE_KEY)
        .distinct()
        .join(done, QUEUE_KEY, "left_anti")
    )


def _reached(time: str, type_: int, at: bool = False) -> Column:
    t = F.col("timestamp")
    return (F.col("type") == type_) & (t == stamp(time) if at else t <= stamp(time))


def mark(queue: DataFrame, time: str, type_: int, target: int) -> DataFrame:
    """Changes ``type_`` to ``target`` for rows up to a time."""
    changed = F.when(_reached(time, type_), F.lit(target)).otherwise(F.col("type"))
    return queue.withColumn("type", changed)


def purge(queue: DataFrame, time: str, type_: int, at: bool = False) -> DataFrame:
    """Drops rows of a type up to a time, or exactly at it."""
    return queue.where(~F.coalesce(_reached(time, type_, at), F.lit(False)))
