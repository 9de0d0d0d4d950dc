"""Changes to keyed tables as joins and aggregates: target in, new target out.

``source`` must hold one row per key unless a function says otherwise; ``last_per_key``
reduces a batch to that. Nothing is updated in place: callers write the result as a new
table or replace the partitions it touches (``sources.tables.replace_partitions``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NULL_SENTINEL = "-1000"  # fixed value: what a batch put stores for a missing cell


def last_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key; aggregated map-side, so a hot key ships one row per task."""
    rest = [c for c in batch.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return batch.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*batch.columns)


def upsert_replace(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; other rows of both are kept."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def upsert_add(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    add: Sequence[str],
    overwrite: Sequence[str] = (),
) -> DataFrame:
    """Adds the source's amounts to the target's, overwriting the columns named so.

    ``source`` may repeat a key if nothing is overwritten.
    """
    both = target.withColumn("batch", F.lit(0)).unionByName(source.withColumn("batch", F.lit(1)))
    kind = {f.name: f.dataType for f in target.schema.fields}
    return both.groupBy(*keys).agg(
        *[F.sum(c).cast(kind[c]).alias(c) for c in add],
        *[F.max_by(c, "batch").alias(c) for c in overwrite],
    ).select(*keys, *add, *overwrite)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the source rows whose key the target does not have."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def conditional_update(
    target: DataFrame, source: DataFrame, keys: Sequence[str],
    check: str, expected: str, column: str, value: str,
) -> DataFrame:
    """Sets ``column`` to the source's ``value`` where ``check`` equals its ``expected``.

    A key the target lacks is left out: its check column equals nothing.
    """
    asked = source.select(
        *keys, F.col(expected).alias("_expected"), F.col(value).alias("_value"),
        F.lit(True).alias("_asked"),
    )
    hit = F.coalesce(F.col("_asked") & (F.col(check) == F.col("_expected")), F.lit(False))
    joined = target.join(asked, list(keys), "left")
    return joined.withColumn(
        column, F.when(hit, F.col("_value")).otherwise(F.col(column))
    ).select(*target.columns)


def conditional_delete(
    target: DataFrame, source: DataFrame, keys: Sequence[str], check: str, expected: str
) -> DataFrame:
    """Clears ``check`` where it equals the source's ``expected``."""
    asked = source.select(*keys, F.col(expected).alias("_expected"))
    joined = target.join(asked, list(keys), "left")
    hit = F.coalesce(F.col(check) == F.col("_expected"), F.lit(False))
    return joined.withColumn(check, F.when(~hit, F.col(check))).select(*target.columns)


def counter_increment(
    target: DataFrame, amounts: DataFrame, keys: Sequence[str], counter: str
) -> DataFrame:
    """Adds every amount to its key's counter, which starts at 0; keys may repeat."""
    return upsert_add(target, amounts, keys, [counter])


def append_value(
    target: DataFrame, source: DataFrame, keys: Sequence[str], column: str
) -> DataFrame:
    """Appends text to a cell, creating the row when the key is new."""
    tail = source.select(*keys, F.col(column).alias("_tail"))
    joined = target.join(tail, list(keys), "full_outer")
    text = F.concat(F.coalesce(column, F.lit("")), F.coalesce("_tail", F.lit("")))
    changed = F.when(F.col("_tail").isNotNull(), text).otherwise(F.col(column))
    return joined.withColumn(column, changed).select(*target.columns)


def delete_by_keys(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(doomed.select(*keys), list(keys), "left_anti").select(*target.columns)


def truncate(target: DataFrame) -> DataFrame:
    """The table with its schema and no rows."""
    return target.limit(0)


def null_sentinel(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as text, with the sentinel in place of nulls."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit(NULL_SENTINEL)) for c in columns}
    )


def _bounds(df: DataFrame, keys: Sequence[str], parts: int) -> list:
    """About ``parts`` keys spread over the table, in order; a bounded top-k by hash."""
    picked = df.select(*keys).orderBy(F.xxhash64(*keys), *keys).limit(parts - 1)
    return picked.orderBy(*keys).collect()


def number_in_order(df: DataFrame, keys: Sequence[str], name: str, parts: int | None = None) -> DataFrame:
    """Adds 1, 2, 3, ... in key order without sorting everything in one task.

    Rows fall into ranges between a few hash-picked keys, are numbered inside their range
    and shifted by the size of the ranges before it. Any choice of ranges gives the same
    numbers. Keys must be unique.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*keys)
    bounds = [
        F.struct(*[F.lit(row[k]).cast(df.schema[k].dataType).alias(k) for k in keys])
        for row in _bounds(df, keys, parts)
    ]
    below = F.size(F.filter(F.array(*bounds), lambda b: b <= key)) if bounds else F.lit(0)
    ranged = df.withColumn("_range", below)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    # One row per range, at most ``parts`` of them.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    in_range = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return (
        ranged.withColumn("_n", in_range)
        .join(starts, "_range")
        .withColumn(name, F.col("_start") + F.col("_n"))
        .drop("_range", "_n", "_start")
    )


def assign_ids(rows: DataFrame, stored: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """Gives each distinct key its stored id, and new keys the next ids in key order.

    ``rows`` may repeat a key only with identical rows. The largest stored id is a scalar
    subquery, so nothing comes to the driver but the range bounds.
    """
    distinct = rows.dropDuplicates()
    ids = stored.select(*keys, F.col(id_col).cast("long").alias(id_col))
    known = distinct.join(ids, list(keys))
    fresh = distinct.join(ids, list(keys), "left_anti")
    top = stored.agg(F.coalesce(F.max(id_col).cast("long"), F.lit(0))).scalar()
    numbered = number_in_order(fresh, keys, id_col)
    numbered = numbered.withColumn(id_col, (top + F.col(id_col)).cast("long"))
    columns = [id_col, *rows.columns]
    return known.select(*columns).unionByName(numbered.select(*columns))
