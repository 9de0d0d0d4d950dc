"""The stored result tables of one deployment: where they are, and refreshing the derived ones.

Hour rows, states, queue rows and marks belong to the batch that wrote them. Virtual rows, days,
months and sub-entries are always recomputed for whole partitions from the rows below them.
So running a step again leaves the same tables. A partition that is to become empty gets a
row without a key, which readers do not see: so a rerun or a recompute never leaves old rows
where there are none now.

The state is a log: a batch writes the series it touched, and now and then all of them as they
are. The marks are a ledger: which third-party reports are counted, and which batch counted them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.functions import times
from gridtally.operators.dims import Dimensions
from gridtally.operators.merge import assign_ids, last_per_key
from gridtally.operators.rollup import day_rollup, month_rollup
from gridtally.operators import intervals
from gridtally.operators.queue import DONE, THIRD_PARTY, pending_third_party
from gridtally.operators.subentry import (
    add_buckets, subentry_day, subentry_hour, third_party_amounts,
)
from gridtally.operators.virtual import virtual_hour
from gridtally.schemas import (
    AMOUNT, HOUR_KEY, HOUR_SCHEMA, QUEUE_SCHEMA, SERIES_KEY, STATE_SCHEMA, SUBENTRY_BUCKETS,
    TOTAL,
)
from gridtally.sources.shared import stored_at
from gridtally.sources.tables import (
    create_table, drop_partitions, read_table, replace_partitions,
)


def _with(schema: T.StructType, *names_and_types: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in names_and_types]])


def _totals(schema: T.StructType) -> T.StructType:
    """Hour columns with the wider type of sums."""
    wide = {"value", "rate"}
    return T.StructType(
        [T.StructField(f.name, TOTAL if f.name in wide else f.dataType) for f in schema.fields]
    )


# Batches from here on are steps of a backfill; their hour rows win over live ones. Every run
# of a backfill has its own STEPS batches.
BACKFILL = 1_000_000_000_000
STEPS = 1_000
#: Batches from here on are third-party reports, which are queue rows only.
REPORTS = 2 * BACKFILL
#: Fixed value: how long a counted report is remembered, twelve months of thirty days.
RETENTION = timedelta(days=12 * 30)
#: The state is written whole by every so many batches; the others write changes only.
SNAPSHOT_EVERY = 16
SNAPSHOT, CHANGE = "snapshot", "change"

DAY_PART = ("day", T.DateType())
MONTH_PART = ("month", T.DateType())
BATCH_PART = ("batch", T.LongType())

SUBENTRY_SCHEMA = T.StructType([
    T.StructField("building_code", T.StringType()),
    *[T.StructField(b, TOTAL) for b in SUBENTRY_BUCKETS],
    T.StructField("rate", TOTAL),
    T.StructField("data_time", T.TimestampType()),
])

AMOUNTS_SCHEMA = T.StructType([
    T.StructField("item_name", T.StringType()),
    T.StructField("type_id", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("hour", T.TimestampType()),
    T.StructField("n_readings", T.LongType()),
    T.StructField("amount", AMOUNT),
    T.StructField("max_value", AMOUNT),
])

SCHEMAS = {
    "amounts": _with(AMOUNTS_SCHEMA, BATCH_PART),
    "hour": _with(HOUR_SCHEMA, DAY_PART, BATCH_PART),
    "virtual_hour": _with(HOUR_SCHEMA, DAY_PART),
    "day": _with(
        _totals(HOUR_SCHEMA), ("work_time_value", AMOUNT), ("other_time_value", AMOUNT),
        MONTH_PART, DAY_PART,
    ),
    "month": _with(_totals(HOUR_SCHEMA), MONTH_PART),
    "subentry_hour": _with(SUBENTRY_SCHEMA, DAY_PART),
    "subentry_day": _with(SUBENTRY_SCHEMA, DAY_PART),
    "queue": _with(QUEUE_SCHEMA, DAY_PART, BATCH_PART),
    "marks": _with(T.StructType(QUEUE_SCHEMA.fields[:3]), DAY_PART, BATCH_PART),
    "ticks": T.StructType([T.StructField("tick", T.StringType()), T.StructField(*BATCH_PART)]),
    "third_party": _with(SUBENTRY_SCHEMA, DAY_PART),
    "ids": T.StructType([
        *STATE_SCHEMA.fields[:2], T.StructField("id", T.LongType()), T.StructField(*BATCH_PART),
    ]),
    "writes": T.StructType([
        T.StructField("table_name", T.StringType()), T.StructField("n_rows", T.LongType()),
        T.StructField(*BATCH_PART),
    ]),
    "state": _with(STATE_SCHEMA, ("kind", T.StringType()), BATCH_PART),
    "ranges": T.StructType([
        T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType()),
        T.StructField("refreshed", T.BooleanType()), T.StructField(*BATCH_PART),
    ]),
}

PARTITIONS = {
    "amounts": ["batch"],
    "hour": ["day", "batch"],
    "virtual_hour": ["day"],
    "day": ["month", "day"],
    "month": ["month"],
    "subentry_hour": ["day"],
    "subentry_day": ["day"],
    "queue": ["day", "batch"],
    "marks": ["day", "batch"],
    "ticks": ["batch"],
    "third_party": ["day"],
    "ids": ["batch"],
    "writes": ["batch"],
    "state": ["kind", "batch"],
    "ranges": ["batch"],
}

# A column that no row lacks.
KEYS = {
    "amounts": "item_name", "hour": "item_name", "virtual_hour": "item_name", "day": "item_name",
    "month": "item_name", "subentry_hour": "building_code", "subentry_day": "building_code",
    "queue": "build_code", "marks": "build_code", "ticks": "tick", "third_party": "building_code",
    "ids": "item_name", "writes": "table_name",
    "state": "item_name", "ranges": "start",
}


class MeterTables:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str, snapshot_every: int = SNAPSHOT_EVERY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.snapshot_every = snapshot_every

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, days: Iterable[date] | None = None) -> DataFrame:
        """A table, or only some of its day partitions."""
        rows = self._stored(name).where(F.col(KEYS[name]).isNotNull())
        return rows if days is None else rows.where(F.col("day").isin(list(days)))

    def _stored(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name), SCHEMAS[name])

    def create(self) -> MeterTables:
        """Makes the tables that a job reads before it has written them."""
        for name in ("state", "hour", "queue", "ranges", "marks", "ticks", "third_party", "ids"):
            create_table(self.spark, self.path(name), SCHEMAS[name], PARTITIONS[name])
        return self

    def replace(self, name: str, rows: DataFrame, touched: DataFrame | None = None) -> None:
        """Writes partitions anew; those in ``touched`` that have no rows become empty."""
        if touched is not None:
            empty = touched.select(*PARTITIONS[name])
            rows = rows.unionByName(empty, allowMissingColumns=True)
        replace_partitions(rows, self.path(name), PARTITIONS[name])

    def write_counts(self, batch: int, days: Sequence[date] = ()) -> None:
        """Stores how many rows each table has from a batch, and each derived one for its days.

        One job over the key columns of the partitions that the batch has just written.
        """
        parts = [
            (name, self.read(name).where(F.col("batch") == batch))
            for name in ("hour", "queue", "marks", "state", "ids")
        ]
        if days:
            parts += [(name, self.read(name, days))
                      for name in ("virtual_hour", "day", "subentry_hour", "subentry_day")]
        counts = [
            (rows.where(F.col("kind") == CHANGE) if name == "state" else rows)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("table_name"), "n_rows", F.lit(batch).alias("batch"))
            for name, rows in parts
        ]
        self.replace("writes", reduce(DataFrame.unionByName, counts))

    def write_ids(self, series: DataFrame, batch: int) -> None:
        """Gives series that no earlier batch has seen the next ids, in key order.

        Ids never change, and a batch that runs again gives its own series the same ones. Only
        they are written.
        """
        keys = series.select(*SERIES_KEY).distinct()
        known = self.read("ids").where(F.col("batch") < batch)
        fresh = keys.join(known, SERIES_KEY, "left_anti")
        rows = assign_ids(fresh, known.drop("batch"), SERIES_KEY).withColumn("batch", F.lit(batch))
        self.replace("ids", rows, self.spark.createDataFrame([(batch,)], "batch long"))

    def newest_batch(self, name: str, below: int | None = None) -> int:
        """The last batch that wrote a table, from partition names; -1 if there is none."""
        batches = self._stored(name).select("batch")
        if below is not None:
            batches = batches.where(F.col("batch") < below)
        newest = batches.agg(F.max("batch")).first()[0]
        return -1 if newest is None else newest

    def next_run(self) -> int:
        """The number of a backfill that has not run yet."""
        newest = self.newest_batch("ranges")
        return 0 if newest < BACKFILL else (newest - BACKFILL) // STEPS + 1

    def write_range(self, start: str, end: str, batch: int, refreshed: bool = True) -> None:
        """Notes which times a step of a backfill has computed, and whether all of its tables."""
        row = self.spark.range(1).select(
            times.parse_time(F.lit(start)).alias("start"),
            times.parse_time(F.lit(end)).alias("end"), F.lit(refreshed).alias("refreshed"),
            F.lit(batch).alias("batch"),
        )
        self.replace("ranges", row)

    def missing(self, start: str, end: str, beyond: int = 0) -> list[tuple[str, str]]:
        """The parts of ``[start, end)`` that no finished step of a backfill has computed.

        Each goes on for ``beyond`` hours more, up to the end. There are fewer than steps.
        """
        since, until = (times.parse_time(F.lit(t)) for t in (start, end))
        wanted = self.spark.range(1).select(since.alias("start"), until.alias("end"))
        done = self.read("ranges").where("refreshed").select("start", "end")
        stop = F.least(F.col("end") + times.hours(beyond), until)
        gaps = intervals.subtract(wanted, done).orderBy("start").select(
            times.to_dashed(F.col("start")).alias("start"), times.to_dashed(stop).alias("end"))
        return [(r.start, r.end) for r in gaps.collect()]

    def hours(self, days: Sequence[date]) -> DataFrame:
        """Hour rows of some days, one per key: where a backfill wrote any, the last one wins.

        Of an earlier backfill nothing is left among the hours that a later one computed, those
        whose next hour begins in its range, whether or not it has a row for them. Live batches never repeat a key, so without a
        backfill there is nothing to reduce; the test reads no file unless such partitions
        exist.
        """
        rows = self.read("hour", days)
        if not rows.where(F.col("batch") >= BACKFILL).isEmpty():
            # The last run of every hour of these days; a range counts hours, not seconds.
            since, until = min(days), max(days) + timedelta(days=1)
            begun = F.date_trunc("hour", "start")
            first = F.when(begun == F.col("start"), begun - times.hours(1)).otherwise(begun)
            last = F.date_trunc("hour", F.col("end") - times.hours(1) - F.expr("interval 1 microsecond"))
            first = F.greatest(first, F.lit(since).cast("timestamp"))
            last = F.least(last, F.lit(until).cast("timestamp"))
            runs = self.read("ranges").select(
                first.alias("first"), last.alias("last"), _first_step(F.col("batch")).alias("owner")
            ).where(F.col("first") <= F.col("last"))
            owners = runs.select(
                F.explode(F.sequence("first", "last", F.expr("interval 1 hour"))).alias("date_time"), "owner"
            ).groupBy("date_time").agg(F.max("owner").alias("owner"))
            older = F.col("batch").between(BACKFILL, F.col("owner") - 1)
            rows = rows.join(owners, "date_time", "left").where(~F.coalesce(older, F.lit(False)))
            rows = last_per_key(rows.drop("owner"), HOUR_KEY, ["batch"])
            rows = rows.select(*self._stored("hour").columns)
        return rows.drop("batch")

    def write_hours(self, rows: DataFrame, batch: int) -> None:
        rows = rows.withColumn("day", F.to_date("date_time")).withColumn("batch", F.lit(batch))
        self.replace("hour", rows, self._written("hour", batch))

    def _written(self, name: str, batch: int) -> DataFrame:
        """The partitions that a batch has already; a handful, made apart from the files."""
        mine = self._stored(name).where(F.col("batch") == batch).select("day", "batch").distinct()
        return self.spark.createDataFrame(mine.collect(), mine.schema)

    def write_queue(self, rows: DataFrame, batch: int) -> None:
        """Queue rows under the day of the hour that their virtual rows belong to."""
        due = times.stamp_to_hour(F.col("timestamp")) - times.hours(1)
        rows = rows.withColumn("day", F.to_date(due)).withColumn("batch", F.lit(batch))
        self.replace("queue", rows, self._written("queue", batch))

    def report(self, rows: DataFrame, number: int) -> None:
        """Queue rows of a third party: collectors and hours with its amounts (type 2), or ones
        that are counted elsewhere (type 3). The same number again replaces them."""
        known = rows.where(
            F.col("type").isin(THIRD_PARTY, DONE) & times.stamp_to_hour(F.col("timestamp")).isNotNull()
        )
        self.write_queue(known.select(*QUEUE_SCHEMA.names), REPORTS + number)

    def settle(self, batch: int) -> None:
        """Marks the reports that are due and not marked by another batch.

        They are due up to the batch's tick: the last hour that any reading has been queued for,
        so event time decides and a replay marks the same ones. Reports and marks from before
        RETENTION go.
        """
        tick = self._tick(batch)
        if tick is None:
            return
        self.replace("ticks", self.spark.range(1).select(
            F.lit(tick).alias("tick"), F.lit(batch).alias("batch")))
        since = _expiry(tick)
        reports = self.read("queue").where((F.col("batch") >= REPORTS) & (F.col("day") >= since))
        marked = self.read("marks").where((F.col("batch") != batch) & (F.col("day") >= since))
        marked = marked.withColumn("type", F.lit(DONE))
        names = QUEUE_SCHEMA.names
        due = pending_third_party(reports.select(*names).unionByName(marked.select(*names)), tick)
        due = due.withColumn("day", F.to_date(times.stamp_to_hour(F.col("timestamp"))))
        self.replace("marks", due.where(F.col("day") >= since).withColumn("batch", F.lit(batch)),
                     self._written("marks", batch))
        for name in ("queue", "marks"):
            old = self._stored(name).where(F.col("day") < since)
            if name == "queue":
                old = old.where(F.col("batch") >= REPORTS)
            # Partition names of a few days, those that expired since the last batch.
            parts = [r.asDict() for r in old.select("day", "batch").distinct().collect()]
            drop_partitions(self.spark, self.path(name), parts)

    def _tick(self, batch: int) -> str | None:
        """The last stamp that own queue rows had up to a batch."""
        own = self.read("queue").where(F.col("batch") == batch).select(F.col("timestamp").alias("tick"))
        before = self.newest_batch("ticks", below=batch)
        earlier = self.read("ticks").where(F.col("batch") == before).select("tick")
        return own.unionByName(earlier).agg(F.max("tick")).first()[0]

    def state(self, batch: int, only: DataFrame | None = None) -> DataFrame:
        """The state after a batch: the snapshot before it and what changed since.

        ``only`` has the series that are asked for; others are left out before rows are shuffled.
        """
        base = self._snapshot(batch)
        asked = ((F.col("kind") == SNAPSHOT) & (F.col("batch") == base)) | (
            (F.col("kind") == CHANGE) & (F.col("batch") > base) & (F.col("batch") <= batch))
        rows = self.read("state").where(asked)
        if only is not None:
            rows = rows.join(only.select(*SERIES_KEY).distinct(), SERIES_KEY, "left_semi")
        return last_per_key(rows.drop("kind"), SERIES_KEY, ["batch"]).drop("batch")

    def _snapshot(self, batch: int) -> int:
        """The newest snapshot up to a batch, from partition names; -1 if there is none."""
        found = self._stored("state").where((F.col("kind") == SNAPSHOT) & (F.col("batch") <= batch))
        newest = found.agg(F.max("batch")).first()[0]
        return -1 if newest is None else newest

    def write_state(self, rows: DataFrame, batch: int, kind: str = SNAPSHOT) -> None:
        touched = self.spark.createDataFrame([(kind, batch)], "kind string, batch long")
        self.replace("state", rows.withColumn("kind", F.lit(kind)).withColumn("batch", F.lit(batch)), touched)

    def write_changes(self, rows: DataFrame, batch: int) -> None:
        """The series that a batch touched; now and then also all of them, and what no later
        batch and no replay of this one reads goes."""
        self.write_state(rows, batch, CHANGE)
        base = self._snapshot(batch - 1)
        since = self._stored("state").where(
            (F.col("kind") == CHANGE) & (F.col("batch") > base) & (F.col("batch") <= batch))
        if since.select("batch").distinct().count() < self.snapshot_every:
            return
        self.write_state(self.state(batch), batch)
        old = self._stored("state").where(
            (F.col("batch") < base) | ((F.col("batch") == base) & (F.col("kind") == CHANGE)))
        parts = [r.asDict() for r in old.select("kind", "batch").distinct().collect()]
        drop_partitions(self.spark, self.path("state"), parts)

    def touched_days(self, batch: int) -> list[date]:
        """Days that got hour or queue rows or marks in a batch: a handful, from partition names."""
        parts = [
            self._stored(name).where(F.col("batch") == batch).select("day")
            for name in ("hour", "queue", "marks")
        ]
        return sorted(r.day for r in reduce(DataFrame.union, parts).distinct().collect())

    def refresh(self, dims: Dimensions, days: Sequence[date]) -> None:
        """Recomputes everything derived from the hour rows of ``days``.

        Each table is written before the next one reads it, which also cuts the lineage.
        """
        days = list(days)
        if not days:
            return
        hours = self.hours(days)
        queue = self.read("queue", days).drop("batch", "day")
        virtual = virtual_hour(hours, dims.virtuals, dims.codes, queue, self._work)
        self._replace_days("virtual_hour", virtual, "date_time", days)
        every_hour = hours.unionByName(self.read("virtual_hour", days)).drop("day")
        self._replace_days("day", day_rollup(every_hour), "date_time", days)
        own = subentry_hour(every_hour, dims.subentries)
        self._replace_days(
            "subentry_hour", self._with_third_party(own, hours, dims, days), "data_time", days
        )
        buckets = self.read("subentry_hour", days).drop("day")
        self._replace_days("subentry_day", subentry_day(buckets), "data_time", days)
        months = sorted({d.replace(day=1) for d in days})
        day_rows = self.read("day").where(F.col("month").isin(months)).drop("day", "month")
        month_rows = month_rollup(day_rows).withColumn("month", F.to_date("date_time"))
        touched = self.spark.createDataFrame([(m,) for m in months], "month date")
        self.replace("month", month_rows, touched)

    def _with_third_party(
        self, own: DataFrame, hours: DataFrame, dims: Dimensions, days: Sequence[date]
    ) -> DataFrame:
        """Own sub-entries and the amounts of marked reports, each report once.

        Days whose marks have expired keep the amounts they were last given.
        """
        marks = self.read("marks", days)
        if marks.isEmpty() and self.read("third_party", days).isEmpty():
            return own
        newest = self.read("ticks").where(F.col("batch") == self.newest_batch("ticks")).first()
        open_days = [d for d in days if newest is None or d >= _expiry(newest.tick)]
        amounts = third_party_amounts(marks, hours, dims.subentries)
        if open_days:
            self._replace_days("third_party", amounts, "data_time", open_days)
        return add_buckets(own, self.read("third_party", days).drop("day"))

    def _work(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows that one refresh writes for its next step; the next refresh writes over them."""
        return stored_at(rows, self.path(f"work/{name}"))

    def _replace_days(self, name: str, rows: DataFrame, time: str, days: Sequence[date]) -> None:
        rows = rows.withColumn("day", F.to_date(time)).where(F.col("day").isin(list(days)))
        touched = self.spark.createDataFrame([(d,) for d in days], "day date")
        if "month" in PARTITIONS[name]:
            rows = rows.withColumn("month", F.to_date(F.date_trunc("month", time)))
            touched = touched.withColumn("month", F.trunc("day", "month"))
        self.replace(name, rows, touched)


def _first_step(batch: Column) -> Column:
    """The first batch of the run that a backfill's batch belongs to."""
    return batch - (batch - BACKFILL) % STEPS


def _expiry(tick: str) -> date:
    """The first day that is still remembered at a tick."""
    return (datetime.strptime(tick, "%Y%m%d%H") - RETENTION).date()
