"""Hourly consumption: difference of the first registers of consecutive hours.

Everything after ``hour_firsts`` works on at most one row per series and hour, so even a
series that holds a third of all readings is a few thousand rows a year when the window
sorts it. The readings themselves only meet a hash aggregate with map-side combining.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.functions.times import hours
from gridtally.schemas import (
    AMOUNT, COEFFICIENT, DEFAULT_COEFFICIENT, DEFAULT_MAX_VALUE, HOUR_COLUMNS, SERIES_KEY,
)

ORDER_KEY = "decimal(38,0)"


def arrival_order(ts: Column, pos: Column) -> Column:
    """(time, position) as one number, so that ``min_by`` stays in the hash aggregate.

    A struct key would do the same but makes Spark sort every reading first.
    """
    span = F.lit(Decimal(10**19))  # above any long
    return (F.unix_micros(ts).cast("decimal(17,0)") * span + pos).cast(ORDER_KEY)


def hour_firsts(clean: DataFrame) -> DataFrame:
    """The earliest reading of every series and hour, with the number of readings."""
    order = arrival_order(F.col("reading_ts"), F.col("pos"))
    return clean.groupBy("item_name", "type_id", "type", "hour").agg(
        F.min_by("register", order).alias("register"),
        F.count(F.lit(1)).alias("n_readings"),
    )


def with_limits(firsts: DataFrame, limits: DataFrame) -> DataFrame:
    """Applies the item's coefficient and attaches its ceiling, defaults where unknown."""
    known = limits.select("item_name", "type_id", "max_value", "coefficient")
    coefficient = F.coalesce("coefficient", F.lit(DEFAULT_COEFFICIENT)).cast(COEFFICIENT)
    return firsts.join(known, SERIES_KEY, "left").select(
        "item_name", "type_id", "type", "hour", "n_readings",
        (F.col("register") * coefficient).cast(AMOUNT).alias("amount"),
        F.coalesce("max_value", F.lit(DEFAULT_MAX_VALUE)).cast(AMOUNT).alias("max_value"),
    )


def _emit(amount: Column, previous: Column, max_value: Column) -> list[Column]:
    """Columns of an hour row from two amounts one hour apart."""
    delta = (amount - previous).cast(AMOUNT)
    in_range = (delta >= 0) & (delta < max_value)
    return [
        F.greatest(delta, F.lit(0).cast(AMOUNT)).alias("value"),
        amount.alias("real_value"),
        F.lit(0).cast(AMOUNT).alias("rate"),
        F.when(in_range, F.lit(0)).otherwise(F.lit(2)).alias("error"),
    ]


def _series() -> Window:
    return Window.partitionBy(*SERIES_KEY)


def consecutive_hours(amounts: DataFrame) -> DataFrame:
    """Hour rows for every pair of readings exactly one hour apart."""
    by_hour = _series().orderBy("hour")
    return (
        amounts.withColumn("prev_hour", F.lag("hour").over(by_hour))
        .withColumn("prev_amount", F.lag("amount").over(by_hour))
        .where(F.col("hour") == F.col("prev_hour") + hours(1))
        .select(
            "item_name", "type_id", F.col("prev_hour").alias("date_time"),
            *_emit(F.col("amount"), F.col("prev_amount"), F.col("max_value")),
            "type",
        )
        .select(*HOUR_COLUMNS)
    )


def hourly_consumption(clean: DataFrame, limits: DataFrame) -> DataFrame:
    return consecutive_hours(with_limits(hour_firsts(clean), limits))


def seed_with_state(amounts: DataFrame, state: DataFrame) -> DataFrame:
    """Puts each series' last known hour in front and drops what is not after it.

    ``state`` has item_name, type_id, date_time, real_value. Seeds of series without a
    new reading pass through; they emit nothing.
    """
    seeds = state.select(
        "item_name", "type_id", F.lit(None).cast("string").alias("type"),
        F.col("date_time").alias("hour"), F.lit(0).cast("long").alias("n_readings"),
        F.col("real_value").cast(AMOUNT).alias("amount"),
        F.lit(None).cast(AMOUNT).alias("max_value"),
        F.lit(True).alias("is_seed"),
    )
    tagged = amounts.withColumn("is_seed", F.lit(False)).unionByName(seeds)
    seed_hour = F.max(F.when(F.col("is_seed"), F.col("hour"))).over(_series())
    return (
        tagged.withColumn("seed_hour", seed_hour)
        .where(F.col("is_seed") | F.col("seed_hour").isNull()
               | (F.col("hour") > F.col("seed_hour")))
        .drop("seed_hour")
    )


def hourly_with_state(clean: DataFrame, limits: DataFrame, state: DataFrame) -> DataFrame:
    """Hour rows of a batch that continues from a stored state; late readings are ignored."""
    return consecutive_hours(seed_with_state(with_limits(hour_firsts(clean), limits), state))


def current_info(clean: DataFrame, limits: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Last accepted hour and amount of every series, carried on from ``state`` if given."""
    return last_known(with_limits(hour_firsts(clean), limits), state)


def last_known(amounts: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """``current_info`` from amounts per hour; an old state wins only where nothing is newer."""
    rows = amounts.select(
        "item_name", "type_id", F.col("hour").alias("date_time"),
        F.col("amount").alias("real_value"),
    )
    # A reading in the stored hour is ignored, so at equal hours the state comes first.
    order = F.unix_micros("date_time") * 2
    rows = rows.withColumn("recency", order)
    if state is not None:
        old = state.select(
            "item_name", "type_id", "date_time", F.col("real_value").cast(AMOUNT).alias("real_value")
        ).withColumn("recency", order + 1)
        rows = rows.unionByName(old)
    return rows.groupBy(*SERIES_KEY).agg(
        F.max("date_time").alias("date_time"),
        F.max_by("real_value", "recency").alias("real_value"),
        F.lit("0").alias("status"),
    )


def gap_class(clean: DataFrame) -> DataFrame:
    """What each hour of a series is to the one before: first, consecutive, or after a gap.

    ``n_ignored`` counts the further readings of the same hour, which change nothing.
    """
    previous = F.lag("hour").over(_series().orderBy("hour"))
    step = (F.unix_seconds("hour") - F.unix_seconds("prev_hour")) / 3600
    return (
        hour_firsts(clean)
        .withColumn("prev_hour", previous)
        .select(
            "item_name", "type_id", "hour",
            F.when(F.col("prev_hour").isNull(), "first")
            .when(F.col("hour") == F.col("prev_hour") + hours(1), "consecutive")
            .otherwise("gap").alias("gap_class"),
            step.cast("long").alias("gap_hours"),
            (F.col("n_readings") - 1).alias("n_ignored"),
        )
    )


def hourly_selfjoin(clean: DataFrame, limits: DataFrame) -> DataFrame:
    """The same rows as ``hourly_consumption``, as an equi-join on the shifted hour."""
    amounts = with_limits(hour_firsts(clean), limits)
    earlier = amounts.select(
        "item_name", "type_id", F.col("hour").alias("date_time"),
        (F.col("hour") + hours(1)).alias("hour"), F.col("amount").alias("prev_amount"),
    )
    return amounts.join(earlier, [*SERIES_KEY, "hour"]).select(
        "item_name", "type_id", "date_time",
        *_emit(F.col("amount"), F.col("prev_amount"), F.col("max_value")), "type",
    ).select(*HOUR_COLUMNS)
