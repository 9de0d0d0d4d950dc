"""Day and month tables from hour and day tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.schemas import AMOUNT, DAY_COLUMNS, HOUR_COLUMNS, SERIES_KEY, TOTAL


def rollup(rows: DataFrame, unit: str) -> DataFrame:
    """Per item and day or month: sums, and the real value of the last row.

    Only valid rows count. ``unit`` is ``day`` (from hour rows) or ``month`` (from day
    rows). All aggregates have fixed-width buffers, so this is one hash aggregate with
    map-side combining; a hot item shuffles one row per map task and period.
    """
    out = (
        rows.where(F.col("error") == 0)
        .groupBy(*SERIES_KEY, F.date_trunc(unit, "date_time").alias("period"), "type")
        .agg(
            F.sum("value").cast(TOTAL).alias("value"),
            F.max_by("real_value", "date_time").cast(AMOUNT).alias("real_value"),
            F.sum("rate").cast(TOTAL).alias("rate"),
        )
        .withColumnRenamed("period", "date_time")
        .withColumn("error", F.lit(0))
    )
    if unit != "day":
        return out.select(*HOUR_COLUMNS)
    zero = F.lit(0).cast(AMOUNT)
    return (
        out.withColumn("work_time_value", zero)
        .withColumn("other_time_value", zero)
        .select(*DAY_COLUMNS)
    )


def day_rollup(hour_rows: DataFrame) -> DataFrame:
    return rollup(hour_rows, "day")


def month_rollup(day_rows: DataFrame) -> DataFrame:
    return rollup(day_rows, "month")


def add_to_rollup(stored: DataFrame, new_rows: DataFrame, unit: str) -> DataFrame:
    """A stored day or month table plus the amounts of new hour or day rows.

    Sums add up; the real value is taken from the new rows where there are any.
    """
    added = rollup(new_rows, unit).withColumn("batch", F.lit(1))
    both = stored.withColumn("batch", F.lit(0)).unionByName(added)
    out = both.groupBy(*SERIES_KEY, "date_time", "type").agg(
        F.sum("value").cast(TOTAL).alias("value"),
        F.max_by("real_value", "batch").alias("real_value"),
        F.sum("rate").cast(TOTAL).alias("rate"),
        F.max("error").alias("error"),
        *[F.sum(c).cast(AMOUNT).alias(c) for c in ("work_time_value", "other_time_value")
          if c in stored.columns],
    )
    return out.select(*stored.columns)
