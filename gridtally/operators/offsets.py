"""Where to go on in a partitioned log, and how much of it to take at a time.

Offsets are rows (partition, offset): the next one to read, or the first that is still kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def starting_offsets(recorded: DataFrame, beginnings: DataFrame) -> DataFrame:
    """(partition, offset) to start from, for every partition that the log has.

    A recorded offset above 0 that is below its partition's beginning has aged out; then all
    partitions start at their beginnings, so that none runs ahead of the others. Otherwise each
    goes on where it was recorded; one without a record, or with 0, is read from its beginning. A
    partition recorded twice goes on at the later offset; one that the log no longer has is left out.
    """
    seen = recorded.where(F.col("offset").isNotNull()).groupBy("partition").agg(
        F.max("offset").alias("recorded"))
    both = beginnings.groupBy("partition").agg(F.min("offset").alias("beginning")).join(
        seen, "partition", "left")
    aged = F.coalesce((F.col("recorded") > 0) & (F.col("recorded") < F.col("beginning")), F.lit(False))
    # One row, whatever the log's size; partitions are few.
    lost = both.agg(F.coalesce(F.max(aged), F.lit(False)).alias("lost"))
    start = F.when(F.col("lost"), F.col("beginning")).otherwise(
        F.greatest(F.coalesce("recorded", "beginning"), "beginning"))
    return both.join(F.broadcast(lost)).select("partition", start.cast("long").alias("offset"))


def as_json(offsets: DataFrame, topic: str) -> DataFrame:
    """One row ``offsets``: the text that the Kafka source takes as ``startingOffsets``."""
    entry = F.struct(F.col("partition").cast("string").alias("key"), F.col("offset").alias("value"))
    by_partition = F.map_from_entries(F.sort_array(F.collect_list(entry)))
    return offsets.agg(
        F.to_json(F.create_map(F.lit(topic), by_partition)).alias("offsets")
    )


def next_offsets(log: DataFrame) -> DataFrame:
    """What to record after these rows: one past the last offset of each partition."""
    return log.groupBy("partition").agg((F.max("offset") + 1).cast("long").alias("offset"))


def remaining(log: DataFrame, starts: DataFrame, per_batch: int | None = None) -> DataFrame:
    """The log's rows from the starting offsets on, with ``batch`` 0, 1, 2, ...

    No batch has more than ``per_batch`` offsets of one partition, so a backlog comes in parts of a
    bounded size; without a limit all is batch 0. Rows of a partition without a start are left out.
    """
    begun = starts.select("partition", F.col("offset").alias("start"))
    return log.join(begun, "partition").where(F.col("offset") >= F.col("start")).withColumn(
        "batch", _batch(per_batch)).drop("start")


def _batch(per_batch: int | None) -> Column:
    if per_batch is None:
        return F.lit(0).cast("long")
    if per_batch < 1:
        raise ValueError(f"not a number of offsets: {per_batch}")
    return F.floor((F.col("offset") - F.col("start")) / per_batch).cast("long")
