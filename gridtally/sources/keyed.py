"""Tables laid out by key, so that a point or range lookup opens few files.

The rows are dealt by ranges of the key and sorted, which makes the ranges of the files meet at single
keys only. A small index beside the data has every file's first and last key; a lookup reads the index,
opens the files whose range can hold the key, and inside them Parquet's own statistics and Bloom filters
pass over row groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_keyed(df: DataFrame, path: str, key: str, files: int) -> None:
    """Writes rows by key into about so many files, in place of what was there.

    Rows with a null key lie in the first file. A key with very many rows is spread over its
    range's file only; choose more files where rows are many.
    """
    data = f"{path}/data"
    (
        df.repartitionByRange(files, F.col(f"`{key}`"))
        .sortWithinPartitions(F.col(f"`{key}`"))
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .parquet(data)
    )
    rows = df.sparkSession.read.schema(df.schema).parquet(data)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    k = F.col(f"`{key}`")
    (
        rows.select(name.alias("file"), k.alias("key")).groupBy("file")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count(F.lit(1)).alias("n_rows"))
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/index")
    )


def files_of(spark: SparkSession, path: str, within: Column) -> list[str]:
    """The files whose range (``first``, ``last``) meets a condition: a lookup's few, by name."""
    index = spark.read.parquet(f"{path}/index")
    return sorted(r.file for r in index.where(within).select("file").collect())


def _rows(spark: SparkSession, path: str, names: list[str], key: str, wanted: Column) -> DataFrame:
    if not names:
        return spark.read.parquet(f"{path}/data").limit(0)
    return spark.read.parquet(*[f"{path}/data/{n}" for n in names]).where(wanted)


def get_rows(spark: SparkSession, path: str, key: str, values: Sequence) -> DataFrame:
    """The rows of some keys; nulls among them are passed over."""
    known = [v for v in values if v is not None]
    ranges = [F.lit(v).between(F.col("first"), F.col("last")) for v in known]
    names = files_of(spark, path, F.exists(F.array(*ranges), lambda r: r)) if known else []
    return _rows(spark, path, names, key, F.col(f"`{key}`").isin(known))


def get_range(spark: SparkSession, path: str, key: str, low, high) -> DataFrame:
    """The rows with keys in ``[low, high]``; None leaves an end open."""
    k, inside, meets = F.col(f"`{key}`"), F.col(f"`{key}`").isNotNull(), F.lit(True)
    if low is not None:
        inside, meets = inside & (k >= low), meets & (F.col("last") >= F.lit(low))
    if high is not None:
        inside, meets = inside & (k <= high), meets & (F.col("first") <= F.lit(high))
    return _rows(spark, path, files_of(spark, path, meets), key, inside)
