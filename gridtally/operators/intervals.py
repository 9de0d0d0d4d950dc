"""Half-open time intervals: what several of them cover together, and what they leave out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def islands(ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The ranges (start, end) of each group as few as can be: those that touch or overlap are one.

    Empty ranges and those without a start or an end cover nothing.
    """
    order = Window.partitionBy(*by).orderBy("start", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("end").over(before)
    opens = F.when(reached.isNull() | (F.col("start") > reached), 1).otherwise(0)
    return (
        ranges.where(F.col("start") < F.col("end")).select(*by, "start", "end").distinct()
        .withColumn("opens", opens)
        .withColumn("island", F.sum("opens").over(order))
        .groupBy(*by, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select(*by, "start", "end")
    )


def subtract(wanted: DataFrame, covered: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The parts of the wanted ranges that no covered range of the group has.

    The wanted ranges of a group are taken together. Between two covered islands there is one gap,
    and one at either end; so both sides are cut at each other's borders by a window, not a join.
    """
    both = islands(wanted, by).withColumn("side", F.lit(1)).unionByName(
        islands(covered, by).withColumn("side", F.lit(0)))
    # How many ranges of each side are open from a border on.
    step = F.when(F.col("at") == F.col("start"), 1).otherwise(-1)
    borders = (
        both.withColumn("at", F.explode(F.array("start", "end"))).withColumn("step", step)
        .groupBy(*by, "at").agg(
            F.sum(F.when(F.col("side") == 1, F.col("step")).otherwise(0)).alias("wanted"),
            F.sum(F.when(F.col("side") == 0, F.col("step")).otherwise(0)).alias("covered"),
        )
    )
    order = Window.partitionBy(*by).orderBy("at")
    return (
        borders.select(
            *by, F.col("at").alias("start"), F.lead("at").over(order).alias("end"),
            F.sum("wanted").over(order).alias("wanted"), F.sum("covered").over(order).alias("covered"),
        )
        .where("wanted = 1 and covered = 0").select(*by, "start", "end")
    )
