"""Per-building electricity, split into five buckets by the sub-entry code of each item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions import text, times
from gridtally.schemas import (
    AMOUNT, SUBENTRY_BUCKETS, SUBENTRY_COLUMNS, SUBENTRY_KEY, THIRD_PARTY_CEILING, TOTAL,
)


def _bucket_sums(amount: Column) -> list[Column]:
    prefix = text.subentry_prefix(F.col("subentry_code"))
    zero = F.lit(0).cast(AMOUNT)
    return [
        F.sum(F.when(prefix == code, amount).otherwise(zero)).cast(TOTAL).alias(name)
        for name, code in SUBENTRY_BUCKETS.items()
    ]


def subentry_hour(hour_rows: DataFrame, subentry_map: DataFrame) -> DataFrame:
    """Buckets per building and hour from valid electric hour rows.

    A mapped item whose code fits no bucket still makes a row of zeros; an unmapped
    item makes none.
    """
    codes = subentry_map.select("item_name", "subentry_code")
    return (
        hour_rows.where((F.col("error") == 0) & text.is_electric(F.col("type")))
        .select("item_name", "date_time", "value")
        .join(codes, "item_name")
        .groupBy(
            text.building_of(F.col("item_name")).alias("building_code"),
            F.col("date_time").alias("data_time"),
        )
        .agg(*_bucket_sums(F.col("value")), F.lit(0).cast(TOTAL).alias("rate"))
        .select(*SUBENTRY_COLUMNS)
    )


def subentry_day(hour_buckets: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast(TOTAL).alias(c) for c in [*SUBENTRY_BUCKETS, "rate"]]
    return (
        hour_buckets.groupBy("building_code", F.date_trunc("day", "data_time").alias("day"))
        .agg(*sums)
        .withColumnRenamed("day", "data_time")
        .select(*SUBENTRY_COLUMNS)
    )


def third_party_amounts(
    pending: DataFrame, hour_rows: DataFrame, subentry_map: DataFrame
) -> DataFrame:
    """Buckets of the collectors that a third party reported, per building and hour.

    ``pending`` has build_code, collector_code, timestamp. All electric hour rows of the
    collector at that hour count, valid or not, below a ceiling.
    """
    wanted = pending.select(
        "build_code", "collector_code",
        times.stamp_to_hour(F.col("timestamp")).alias("date_time"),
    ).distinct()
    rows = hour_rows.where(text.is_electric(F.col("type"))).select(
        text.building_of(F.col("item_name")).alias("build_code"),
        text.collector_of(F.col("item_name")).alias("collector_code"),
        "date_time", "item_name", "value",
    )
    codes = subentry_map.select("item_name", "subentry_code")
    counted = F.when(F.col("value") < THIRD_PARTY_CEILING, F.col("value")).otherwise(
        F.lit(0).cast(AMOUNT)
    )
    return (
        rows.join(wanted, ["build_code", "collector_code", "date_time"])
        .join(codes, "item_name", "left")
        .groupBy(F.col("build_code").alias("building_code"), F.col("date_time").alias("data_time"))
        .agg(*_bucket_sums(counted), F.lit(0).cast(TOTAL).alias("rate"))
        .select(*SUBENTRY_COLUMNS)
    )


def add_buckets(stored: DataFrame, added: DataFrame) -> DataFrame:
    """Adds sub-entry amounts to a stored hour or day table, keeping all rows of both."""
    sums = [F.sum(c).cast(TOTAL).alias(c) for c in [*SUBENTRY_BUCKETS, "rate"]]
    return (
        stored.unionByName(added).groupBy(*SUBENTRY_KEY).agg(*sums).select(*SUBENTRY_COLUMNS)
    )
