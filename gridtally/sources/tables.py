"""Scans of stored tables, and writing them partition by partition."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(
    table: DataFrame, columns: Sequence[str] | None = None, wheres: Sequence[Column] = ()
) -> DataFrame:
    """Some or all columns of the rows that meet every condition."""
    if wheres:
        table = table.where(reduce(and_, wheres))
    return table.select(*columns) if columns else table


def energy_scan(
    table: DataFrame,
    start: datetime | str,
    end: datetime | str | None = None,
    code: str | None = None,
    time_column: str = "date_time",
    code_column: str = "item_name",
) -> DataFrame:
    """Rows at ``start``, or in ``[start, end)`` when an end is given; of one key if asked."""
    t, since = F.col(time_column), F.lit(str(start)).cast("timestamp")
    if end is None:
        table = table.where(t == since)
    else:
        table = table.where((t >= since) & (t < F.lit(str(end)).cast("timestamp")))
    return table if code is None else table.where(F.col(code_column) == code)


def get_row(table: DataFrame, key: str, value) -> DataFrame:
    return table.where(F.col(key) == F.lit(value))


def joined_cells(columns: Sequence[str]) -> Column:
    """Cell values in column-name order, separated by commas; nulls have no cell."""
    return F.concat_ws(",", *[F.col(c).cast("string") for c in sorted(columns)])


def _matches(key: str, patterns: Sequence[str]) -> list[Column]:
    return [F.col(key).rlike(p) for p in patterns]


def key_range_regex_scan(
    table: DataFrame, key: str, start: str, end: str,
    columns: Sequence[str], patterns: Sequence[str] = (),
) -> DataFrame:
    """(key, cells) of keys in ``[start, end]`` in which every pattern is found."""
    rows = scan(table, None, [F.col(key).between(start, end), *_matches(key, patterns)])
    return rows.select(F.col(key), joined_cells(columns).alias("cells"))


def column_range_scan(
    table: DataFrame, key: str, column: str, start, end,
    columns: Sequence[str], patterns: Sequence[str] = (),
) -> DataFrame:
    """(key, cells) of rows whose column is in ``[start, end]``.

    A row without a value in the column passes, as in a single-column value filter.
    """
    inside = F.col(column).between(start, end) | F.col(column).isNull()
    rows = scan(table, None, [inside, *_matches(key, patterns)])
    return rows.select(F.col(key), joined_cells(columns).alias("cells"))


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("n_rows"))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def create_table(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str]) -> None:
    """Makes an empty partitioned table unless there is one already."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Writes the partitions that occur in ``df`` in place of the stored ones.

    Running it again with the same rows changes nothing. ``df`` must not read ``path``.
    Rows are rebalanced by partition, so small days make one file and a huge one many.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def drop_partitions(spark: SparkSession, path: str, parts: Sequence[dict]) -> None:
    """Deletes partitions, named by their columns in order; one that is not there is passed over.

    For partitions that no reader asks for any more: they go with their files.
    """
    for part in parts:
        folder = "/".join([path, *[f"{name}={value}" for name, value in part.items()]])
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
