"""Lookups resolved from the dimension tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions import text
from gridtally.schemas import AMOUNT, COEFFICIENT, DEFAULT_COEFFICIENT, DEFAULT_MAX_VALUE

ELECTRIC_TYPE_ID = 11  # fixed value: the data type whose items carry a sub-entry


def _placed_items(building: DataFrame, collector: DataFrame, item: DataFrame) -> DataFrame:
    """Every item with the codes of its collector and building."""
    b = building.select(F.col("id").alias("building_id"), F.col("code").alias("building_code"))
    c = collector.select(
        F.col("id").alias("collector_id"), F.col("code").alias("collector_code"), "building_id"
    )
    i = item.withColumnRenamed("id", "item_id").withColumnRenamed("code", "item_code")
    return i.join(c, "collector_id").join(b, "building_id").withColumn(
        "item_name",
        text.item_name(F.col("building_code"), F.col("collector_code"), F.col("item_code")),
    )


def item_limits(
    building: DataFrame,
    collector: DataFrame,
    item: DataFrame,
    building_code: str | None = None,
    collector_code: str | None = None,
    item_code: str | None = None,
) -> DataFrame:
    """(item_name, type_id) -> max_value, coefficient; null or negative means the default."""

    def or_default(name: str, default: int, kind) -> Column:
        x = F.col(name).cast(kind)
        return F.when(x >= 0, x).otherwise(F.lit(default).cast(kind)).alias(name)

    wanted = {
        "building_code": building_code, "collector_code": collector_code, "item_code": item_code,
    }
    placed = _placed_items(building, collector, item)
    for name, code in wanted.items():
        if code is not None:
            placed = placed.where(F.col(name) == code)
    return placed.select(
        "item_name", F.col("data_type").cast("int").alias("type_id"),
        or_default("max_value", DEFAULT_MAX_VALUE, AMOUNT),
        or_default("coefficient", DEFAULT_COEFFICIENT, COEFFICIENT),
    )


def item_codes(building: DataFrame, collector: DataFrame, item: DataFrame) -> DataFrame:
    """item id -> item_name and data type."""
    return _placed_items(building, collector, item).select(
        F.col("item_id").cast("long").alias("item_id"), "item_name",
        F.col("data_type").cast("int").alias("type_id"),
    )


def subentry_map(
    building: DataFrame, collector: DataFrame, item: DataFrame, subentry: DataFrame
) -> DataFrame:
    """item_name -> sub-entry code, for electric items."""
    codes = subentry.select(F.col("id").alias("subentry"), F.col("code").alias("subentry_code"))
    electric = item.where(F.col("data_type") == ELECTRIC_TYPE_ID)
    return (
        _placed_items(building, collector, electric)
        .join(codes, "subentry")
        .select("item_name", "building_code", "subentry_code")
    )


def virtual_items(
    building: DataFrame,
    collector: DataFrame,
    item: DataFrame,
    item_virtual: DataFrame,
    item_type: DataFrame,
) -> DataFrame:
    """Items defined by a formula, with their place and medium."""
    formulas = item_virtual.select("item_id", "formula")
    media = item_type.select(
        F.col("id").alias("data_type"), F.col("code").alias("type_code"), "table_name",
        F.col("basic_code").alias("type"),
    )
    return (
        _placed_items(building, collector, item)
        .join(formulas, "item_id")
        .join(media, "data_type")
        .select(
            "item_name", "building_code", "collector_code", "item_code", "formula",
            F.col("max_value").cast(AMOUNT).alias("max_value"),
            F.col("data_type").cast("int").alias("type_id"),
            "type_code", "table_name", "type",
        )
    )


@dataclass(frozen=True)
class Dimensions:
    """The six dimension tables and the lookups the jobs need from them."""

    building: DataFrame
    collector: DataFrame
    item: DataFrame
    item_type: DataFrame
    item_virtual: DataFrame
    subentry: DataFrame

    @property
    def limits(self) -> DataFrame:
        return item_limits(self.building, self.collector, self.item)

    @property
    def codes(self) -> DataFrame:
        return item_codes(self.building, self.collector, self.item)

    @property
    def subentries(self) -> DataFrame:
        return subentry_map(self.building, self.collector, self.item, self.subentry)

    @property
    def virtuals(self) -> DataFrame:
        return virtual_items(
            self.building, self.collector, self.item, self.item_virtual, self.item_type
        )
