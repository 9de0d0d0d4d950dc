"""One Spark query per operator, over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.functions import numbers, text, times
from gridtally.operators import (
    casting, clean, hourly, merge, offsets, rollup, subentry, virtual,
)
from gridtally.operators import queue as work_queue
from gridtally.plans.backfill import backfill, resume
from gridtally.plans.tables import MeterTables
from gridtally.schemas import READING_FIELDS, SUBENTRY_BUCKETS, as_double
from gridtally.sources import readings as sources
from gridtally.sources import keyed, tables
from gridtally.streaming import hourly as hourly_streams
from gridtally.streaming import ingest, live
from workload import params as P
from workload import views
from workload.session import scratch

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_readings(
        views.readings(spark, sf), views.meter_dimensions(spark, sf).item_type, P.NOW,
        position="event_id",
    )


def _limits(spark: SparkSession, sf: str) -> DataFrame:
    return views.meter_dimensions(spark, sf).limits


def _hours(spark: SparkSession, sf: str) -> DataFrame:
    return hourly.hourly_consumption(_clean(spark, sf), _limits(spark, sf))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Rows that several parts of a plan read: a table computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored_hours(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(_hours(spark, sf), "hours")


# --- sources


@query
def decode_readings(spark, sf):
    readings = views.readings(spark, sf)
    # Records of bad status arrive cut off, which makes them malformed.
    whole = sources.encode_readings(readings.withColumn("good", F.col("status") == "0"))
    cut = F.substring("value", 1, 5)
    records = whole.select("event_id", F.when(F.col("good"), F.col("value")).otherwise(cut).alias("value"))
    return sources.decode_readings(records)


@query
def history_range_scan(spark, sf):
    return sources.history_range_scan(views.readings(spark, sf), P.FROM, P.TO)


@query
def energy_scan_point(spark, sf):
    return as_double(tables.energy_scan(_hours(spark, sf), P.POINT))


@query
def energy_scan_range(spark, sf):
    return as_double(tables.energy_scan(_hours(spark, sf), P.FROM, P.TO, P.ITEM))


@query
def scan_project_filter(spark, sf):
    return tables.scan(
        views.table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"],
        [F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000],
    )


@query
def key_range_regex_scan(spark, sf):
    return tables.key_range_regex_scan(
        views.table(spark, sf, "customer"), "c_name", P.KEY_FROM, P.KEY_TO,
        ["c_nationkey", "c_mktsegment", "c_custkey"], ["[05]$", "^Customer#"],
    )


@query
def column_range_scan(spark, sf):
    return tables.column_range_scan(
        views.table(spark, sf, "supplier"), "s_name", "s_nationkey", 3, 12,
        ["s_nationkey", "s_name"], ["[0-4]$"],
    )


@query
def indexed_lookup(spark, sf):
    """Some customers' orders, and those of a range of customers, from a table laid out by customer."""
    path = scratch(spark, "orders")
    orders = views.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    keyed.write_keyed(orders, path, "o_custkey", 16)
    some = keyed.get_rows(spark, path, "o_custkey", P.CUSTOMERS)
    between = keyed.get_range(spark, path, "o_custkey", *P.CUSTOMER_RANGE)
    return some.withColumn("lookup", F.lit("keys")).unionByName(between.withColumn("lookup", F.lit("range")))


@query
def row_count(spark, sf):
    return tables.row_count(views.table(spark, sf, "lineitem"))


# --- scalar functions


@query
def valid_time(spark, sf):
    t = F.col("ts_str")
    return views.readings(spark, sf).select(
        "event_id", times.is_valid_time(t, P.SPLIT).alias("valid_strict"),
        times.is_valid_time(t, P.SPLIT, 3600).alias("valid_tolerant"),
    )


@query
def valid_number(spark, sf):
    return views.readings(spark, sf).select(
        "event_id", numbers.is_valid_number(F.col("value")).alias("valid")
    )


@query
def time_normalize(spark, sf):
    ts = times.parse_time(F.col("ts_str"))
    return views.readings(spark, sf).select(
        "event_id", times.to_compact(times.hour_of(ts)).alias("hour_text"),
        times.to_dashed(ts).alias("dashed"),
        times.epoch_seconds(F.col("ts_str")).alias("epoch_seconds"),
    )


@query
def calendar_anchors(spark, sf):
    anchors = times.calendar_anchors(F.col("ts"))
    return views.events(spark, sf).select("event_id", *[c.alias(n) for n, c in anchors.items()])


@query
def decimal_arith(spark, sf):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return as_double(views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        numbers.exact_sum(price, F.col("l_tax")).alias("total"),
        numbers.exact_difference(discount, price).alias("rest"),
        numbers.exact_product(F.col("l_quantity"), discount).alias("product"),
    ))


@query
def round_modes(spark, sf):
    """Signed amounts with ties, cut to two places in every mode."""
    lines = views.table(spark, sf, "lineitem")
    quantity, price = (F.col(c).cast("decimal(12,2)") for c in ("l_quantity", "l_extendedprice"))
    x = (price * F.lit("0.005").cast("decimal(4,3)") - quantity * 5).cast("decimal(18,4)")
    return as_double(lines.select("l_orderkey", "l_linenumber", "l_partkey", *[
        numbers.rounded(x, 2, mode).alias(mode) for mode in numbers.ROUNDING[:-1]
    ]))


@query
def date_helpers(spark, sf):
    date = F.col("o_orderdate").cast("timestamp")
    return views.table(spark, sf, "orders").select(
        "o_orderkey", times.to_dashed(date).alias("text"),
        times.parse_time(times.to_compact(date)).alias("parsed"),
        times.parse_time(F.col("o_orderpriority")).alias("unparsable"),
        times.add_months(date, 1).alias("next_month"),
        times.add_months(date, -13).alias("back_13"),
        times.add_years(date, 1).alias("next_year"),
    )


@query
def tz_display(spark, sf):
    return views.events(spark, sf).select(
        "event_id", times.in_zone(F.col("ts"), "Asia/Shanghai").alias("local_text")
    )


@query
def string_keys(spark, sf):
    building, gate, meter = F.col("building_id"), F.col("gate_id"), F.col("meter_id")
    name = text.item_name(building, gate, meter)
    return views.readings(spark, sf).select(
        "event_id", name.alias("item_name"), text.building_of(name).alias("building"),
        text.collector_of(name).alias("collector"),
        text.collector_code(building, gate).alias("collector_code"),
        text.digits_only(F.col("ts_str")).alias("digits"),
        F.substring("ts_str", 1, 10).alias("first10"),
        text.subentry_prefix(F.col("param_id")).alias("prefix3"),
        F.replace("param_id", F.lit("-"), F.lit("#")).alias("swapped"),
        F.col("param_id").rlike("^[0-9]*$").alias("all_digits"),
        meter.startswith("d").alias("is_constant"),
        F.array_join(F.array(building, gate, meter), "|").alias("parts"),
    )


@query
def sort_points(spark, sf):
    numbers_ = [
        F.col("o_orderkey"), F.col("o_custkey"), F.dayofmonth("o_orderdate").cast("long"),
    ]
    points = F.array(*[
        F.struct(F.concat(F.lit("dp"), n.cast("string")).alias("pointName")) for n in numbers_
    ])
    names = F.transform(text.sort_points(points), lambda p: p["pointName"])
    return views.table(spark, sf, "orders").select(
        "o_orderkey", F.array_join(names, ",").alias("points")
    )


# --- cleaning


@query
def clean_readings(spark, sf):
    return as_double(_clean(spark, sf))


@query
def quarantine_split(spark, sf):
    return clean.flag_quarantine(views.readings(spark, sf), P.NOW)


@query
def route_by_medium(spark, sf):
    return as_double(clean.with_medium(_hours(spark, sf)))


# --- dimensions


@query
def item_limits(spark, sf):
    return as_double(views.catalog_dimensions(spark, sf).limits)


@query
def item_codes(spark, sf):
    return views.catalog_dimensions(spark, sf).codes


@query
def subentry_map(spark, sf):
    return views.catalog_dimensions(spark, sf).subentries


@query
def virtual_items(spark, sf):
    return as_double(views.catalog_dimensions(spark, sf).virtuals)


# --- hourly consumption


@query
def hourly_consumption(spark, sf):
    return as_double(_hours(spark, sf))


@query
def hourly_selfjoin(spark, sf):
    return as_double(hourly.hourly_selfjoin(_clean(spark, sf), _limits(spark, sf)))


@query
def hourly_with_state(spark, sf):
    readings, limits = _clean(spark, sf), _limits(spark, sf)
    before = F.col("reading_ts") < F.lit(P.SPLIT).cast("timestamp")
    state = hourly.current_info(readings.where(before), limits)
    return as_double(hourly.hourly_with_state(readings, limits, state))


@query
def hourly_gap_class(spark, sf):
    return hourly.gap_class(_clean(spark, sf))


@query
def current_info(spark, sf):
    return as_double(hourly.current_info(_clean(spark, sf), _limits(spark, sf)))


# --- rollups


def _side(spark: SparkSession, sf: str, electric: bool) -> DataFrame:
    elec, other = clean.route_by_medium(_hours(spark, sf))
    return elec if electric else other


@query
def day_rollup_elec(spark, sf):
    return as_double(rollup.day_rollup(_side(spark, sf, True)))


@query
def day_rollup_other(spark, sf):
    return as_double(rollup.day_rollup(_side(spark, sf, False)))


@query
def month_rollup_elec(spark, sf):
    return as_double(rollup.month_rollup(rollup.day_rollup(_side(spark, sf, True))))


@query
def month_rollup_other(spark, sf):
    return as_double(rollup.month_rollup(rollup.day_rollup(_side(spark, sf, False))))


@query
def day_rollup_incremental(spark, sf):
    hours = _hours(spark, sf)
    before = F.col("date_time") < F.lit(P.SPLIT).cast("timestamp")
    stored = rollup.day_rollup(hours.where(before))
    return as_double(rollup.add_to_rollup(stored, hours.where(~before), "day"))


def _subentry_hours(spark: SparkSession, sf: str) -> DataFrame:
    return subentry.subentry_hour(
        _hours(spark, sf), views.meter_dimensions(spark, sf).subentries
    )


@query
def subentry_hour(spark, sf):
    return as_double(_subentry_hours(spark, sf))


@query
def subentry_day(spark, sf):
    return as_double(subentry.subentry_day(_subentry_hours(spark, sf)))


@query
def third_party_subentry(spark, sf):
    stored, added = _third_party(spark, sf)
    return as_double(subentry.add_buckets(stored, added))


def _third_party(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Own sub-entries per hour, and those that third parties reported."""
    hours, codes = _stored_hours(spark, sf), views.meter_dimensions(spark, sf).subentries
    pending = work_queue.pending_third_party(views.queue(spark, sf), P.QUEUE_STAMP)
    return subentry.subentry_hour(hours, codes), subentry.third_party_amounts(pending, hours, codes)


@query
def third_party_subentry_day(spark, sf):
    """The same amounts added to the day table."""
    stored, added = _third_party(spark, sf)
    return as_double(subentry.add_buckets(
        subentry.subentry_day(stored), subentry.subentry_day(added)
    ))


# --- virtual meters


def _virtual_hours(spark: SparkSession, sf: str, hours: DataFrame | None = None) -> DataFrame:
    d = views.meter_dimensions(spark, sf)
    own = work_queue.data_access_events(views.arrivals(spark, sf), P.NOW)
    hours = _hours(spark, sf) if hours is None else hours
    return virtual.virtual_hour(hours, d.virtuals, d.codes, own)


@query
def virtual_meter_hour(spark, sf):
    return as_double(_virtual_hours(spark, sf))


@query
def virtual_change(spark, sf):
    """Against rows stored when only the readings of their own building had arrived."""
    hours = _stored_hours(spark, sf)
    own_building = text.building_of(F.col("item_name")) == "B0"
    stored = _virtual_hours(spark, sf, hours.where(own_building))
    return as_double(virtual.changes(_virtual_hours(spark, sf, hours), stored))


@query
def virtual_day_rollup(spark, sf):
    hours = _stored_hours(spark, sf)
    every_hour = hours.unionByName(_virtual_hours(spark, sf, hours))
    return as_double(rollup.day_rollup(every_hour))


@query
def virtual_nested(spark, sf):
    """Items over items over meters, in two buildings, and formulas that read themselves."""
    d = views.nested_dimensions(spark, sf)
    own = work_queue.data_access_events(views.arrivals(spark, sf), P.NOW)
    return as_double(virtual.virtual_hour(_stored_hours(spark, sf), d.virtuals, d.codes, own))


@query
def virtual_propagate(spark, sf):
    """The nested items again: computed from the hours up to a time, then what the rest changes."""
    d = views.nested_dimensions(spark, sf)
    hours = _stored_hours(spark, sf)
    own = _stored(work_queue.data_access_events(views.arrivals(spark, sf), P.NOW), "queue")
    split = F.lit(P.SPLIT).cast("timestamp")
    # Before the split only the hours of even days were there, and the queue had not gone further.
    early = (F.col("date_time") < split) & (F.dayofmonth("date_time") % 2 == 0)
    queued = times.stamp_to_hour(F.col("timestamp")) < split
    formulas = virtual.formulas(d.virtuals, d.codes)
    before = _stored(virtual.virtual_hour(
        hours.where(early), d.virtuals, d.codes, own.where(queued), formulas=formulas), "before")
    after = virtual.propagate(
        before, hours.where(~early), hours, d.virtuals, d.codes, own, own.where(~queued),
        formulas=formulas)
    return as_double(after.rows)


# --- work queue


@query
def data_access_events(spark, sf):
    return work_queue.data_access_events(views.arrivals(spark, sf), P.NOW)


@query
def queue_pending(spark, sf):
    return work_queue.pending(views.queue(spark, sf), P.QUEUE_STAMP)


@query
def queue_pending_third_party(spark, sf):
    return work_queue.pending_third_party(views.queue(spark, sf), P.QUEUE_STAMP)


@query
def queue_mark(spark, sf):
    return work_queue.mark(
        views.queue(spark, sf), P.QUEUE_STAMP, work_queue.THIRD_PARTY, work_queue.DONE
    )


@query
def queue_purge(spark, sf):
    left = work_queue.purge(views.queue(spark, sf), P.QUEUE_STAMP, work_queue.OWN)
    return work_queue.purge(left, P.QUEUE_STAMP, work_queue.THIRD_PARTY, at=True)


# --- table changes


def _money(name: str):
    return F.col(name).cast("decimal(18,2)")


def _order_states(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), "o_orderstatus", "o_orderpriority"
    )


def _line_flags(spark: SparkSession, sf: str) -> DataFrame:
    lines = views.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("key"))
    return lines.agg(
        F.when(F.min("l_linestatus") == "F", "F").otherwise("O").alias("expected"),
        F.max("l_returnflag").alias("value"),
    )


@query
def upsert_replace(spark, sf):
    target = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), _money("c_acctbal").alias("amount"),
        F.col("c_mktsegment").alias("tag"),
    )
    batch = views.table(spark, sf, "orders").select(
        (F.col("o_custkey") + P.KEY_SHIFT).alias("key"), _money("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("tag"), "o_orderdate", "o_orderkey",
    )
    newest = merge.last_per_key(batch, ["key"], ["o_orderdate", "o_orderkey"])
    return as_double(merge.upsert_replace(target, newest, ["key"]))


@query
def upsert_add(spark, sf):
    target = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), _money("o_totalprice").alias("amount")
    )
    lines = views.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("key"), _money("l_extendedprice").alias("amount")
    )
    return as_double(merge.upsert_add(target, lines, ["key"], ["amount"]))


@query
def insert_if_absent(spark, sf):
    target = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name")
    )
    parts = views.table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_name").alias("name")
    )
    return merge.insert_if_absent(target, parts, ["key"])


@query
def conditional_update(spark, sf):
    return merge.conditional_update(
        _order_states(spark, sf), _line_flags(spark, sf), ["key"],
        "o_orderstatus", "expected", "o_orderpriority", "value",
    )


@query
def conditional_delete(spark, sf):
    return merge.conditional_delete(
        _order_states(spark, sf), _line_flags(spark, sf), ["key"], "o_orderstatus", "expected"
    )


@query
def counter_increment(spark, sf):
    counters = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").cast("long").alias("n")
    )
    amounts = views.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.lit(1).cast("long").alias("n")
    )
    return merge.counter_increment(counters, amounts, ["key"], "n")


@query
def append_value(spark, sf):
    target = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("text")
    )
    tails = views.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("key")).agg(
        F.max("o_orderpriority").alias("text")
    )
    return merge.append_value(target, tails, ["key"], "text")


@query
def delete_by_keys(spark, sf):
    lines = views.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    return merge.delete_by_keys(_order_states(spark, sf), lines, ["key"])


@query
def null_sentinel(spark, sf):
    columns = ["name", "value", "ts_str"]
    return merge.null_sentinel(
        views.readings(spark, sf).select("event_id", *columns), columns
    )


@query
def assign_ids(spark, sf):
    keys = ["o_custkey", "o_orderpriority"]
    rows = views.table(spark, sf, "orders").select(*keys)
    stored = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.lit("5-LOW").alias("o_orderpriority"),
        (F.col("c_custkey") + 1).alias("id"),
    )
    return merge.assign_ids(rows, stored, keys)


@query
def cast_by_spec(spark, sf):
    orders = views.table(spark, sf, "orders")
    cells = orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        _money("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", times.DASHED).alias("o_orderdate"),
        (F.col("o_orderstatus") == "F").cast("string").alias("o_orderstatus"),
        "o_orderpriority",
    )
    return as_double(casting.cast_by_spec(cells, {
        "o_orderkey": "bigint", "o_custkey": "tiny", "o_totalprice": "numeric",
        "o_orderdate": "datetime", "o_orderstatus": "bit", "o_orderpriority": "nvarchar",
    }))


@query
def type_check(spark, sf):
    return casting.type_check(views.readings(spark, sf), {
        "value": "decimal", "status": "int", "ts_str": "bigint", "unit": "bit",
        "name": "string", "meter_id": "varchar",
    })


@query
def schema_from_spec(spark, sf):
    kind = F.when(F.col("p_size") > 25, "money").otherwise("nvarchar")
    description = F.concat(
        F.lit('{"columns":{"id":"int","'), F.lower("p_type"), F.lit('":"'), kind,
        F.lit('","taken_at":"datetime"},"rowkey":["id"]}'),
    )
    registry = views.table(spark, sf, "part").select("p_partkey", description.alias("spec"))
    return casting.describe_tables(registry, "spec")


# --- the log

def _log(spark: SparkSession, sf: str) -> DataFrame:
    """Readings as a log of four partitions; of each the first tenth has aged out."""
    order = Window.partitionBy("partition").orderBy("event_id")
    rows = views.events(spark, sf).select("event_id", (F.col("x") % 4).cast("int").alias("partition"))
    rows = rows.withColumn("offset", (F.row_number().over(order) - 1).cast("long"))
    sizes = rows.groupBy("partition").agg(F.floor(F.count(F.lit(1)) / 10).alias("kept_from"))
    return rows.join(sizes, "partition").where("offset >= kept_from").drop("kept_from")


def _resumed(spark: SparkSession, sf: str, recorded: list[tuple[int, int]]) -> DataFrame:
    log = _stored(_log(spark, sf), "log")
    beginnings = log.groupBy("partition").agg(F.min("offset").alias("offset"))
    rows = views.literal(spark, recorded, {"partition": views.INT, "offset": pa.int64()})
    return offsets.remaining(log, offsets.starting_offsets(rows, beginnings), P.PER_BATCH)


@query
def stream_offsets(spark, sf):
    """What is left of the log, in batches, where every record is valid or one has aged out."""
    def tagged(name, rows):
        return rows.withColumn("recorded", F.lit(name))

    return tagged("valid", _resumed(spark, sf, P.VALID_OFFSETS)).unionByName(
        tagged("aged", _resumed(spark, sf, P.AGED_OFFSETS)))


# --- streams and jobs

ARRIVALS = (P.SPLIT,)  # where, inside an hour, the record stream is cut into arrivals


def _arrive(spark: SparkSession, sf: str, folder: str, n: int) -> None:
    """Drops the n-th slice of the records, by event time, into the stream's folder."""
    ts = F.col("ts")
    edges = [None, *[F.lit(t).cast("timestamp") for t in ARRIVALS], None]
    readings = views.readings(spark, sf)
    at = views.events(spark, sf).select("event_id", "ts")
    rows = readings.join(at, "event_id")
    if edges[n] is not None:
        rows = rows.where(ts >= edges[n])
    if edges[n + 1] is not None:
        rows = rows.where(ts < edges[n + 1])
    records = sources.encode_readings(rows.drop("ts")).withColumnRenamed("event_id", "offset")
    records.select("value", "offset").write.mode("append").parquet(folder)


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """All files of an arrival are one batch, however many they are."""
    return spark.readStream.schema("value string, offset long").parquet(folder)


def _sentinel(spark: SparkSession, folder: str) -> None:
    """A last record of no known meter that moves the watermark past all others."""
    reading = ["-", "-", "-", P.UNKNOWN_CODE, None, None, "0", "0", None, P.NOW]
    cells = F.array(*[F.lit(c).cast("string") for c in reading])
    row = spark.range(1).select(
        F.to_json(cells, {"ignoreNullFields": "false"}).alias("value"), F.lit(-1).cast("long").alias("offset")
    )
    row.write.mode("append").parquet(folder)


def _drain(spark: SparkSession, sf: str, folder: str, start, sentinel: bool = False) -> None:
    """Runs a query over the arrivals, one by one, as they come in."""
    for n in range(len(ARRIVALS) + 1):
        _arrive(spark, sf, folder, n)
        start().awaitTermination()
    if sentinel:
        _sentinel(spark, folder)
        start().awaitTermination()


ONCE = {"availableNow": True}


@query
def stream_ingest(spark, sf):
    root = scratch(spark, "ingest")

    def start():
        return ingest.start_ingest(
            _records(spark, f"{root}/records"), f"{root}/tables", f"{root}/checkpoint", P.NOW, ONCE
        )

    _drain(spark, sf, f"{root}/records", start)
    return spark.read.parquet(f"{root}/tables").select(
        *READING_FIELDS, (F.col("kind") == ingest.QUARANTINE).alias("quarantined")
    )


def _stream_to_table(spark: SparkSession, sf: str, name: str, build, sentinel: bool) -> DataFrame:
    root = scratch(spark, name)

    def start():
        readings = sources.decode_readings(_records(spark, f"{root}/records"))
        return (
            build(readings).writeStream.format("parquet").outputMode("append")
            .option("path", f"{root}/hours").option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**ONCE).start()
        )

    _drain(spark, sf, f"{root}/records", start, sentinel)
    return spark.read.parquet(f"{root}/hours")


@query
def stream_hourly(spark, sf):
    d = views.meter_dimensions(spark, sf)

    def build(readings):
        return hourly_streams.hourly_stream(
            readings, d.item_type, d.limits, P.NOW, position="offset"
        )

    return as_double(_stream_to_table(spark, sf, "stream", build, sentinel=True))


@query
def stream_hourly_fold(spark, sf):
    d = views.meter_dimensions(spark, sf)

    def build(readings):
        return hourly_streams.hourly_fold(
            readings, d.item_type, d.limits, now=P.NOW, position="offset"
        )

    return as_double(_stream_to_table(spark, sf, "fold", build, sentinel=False))


def _all_tables(stored: MeterTables, with_state: bool = True) -> DataFrame:
    """Every result table in one long form: table, code, part, time, two values, error."""
    zero = F.lit(0).cast("double")

    def energy(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.lit(name).alias("table_name"), F.col("item_name").alias("code"),
            F.col("type_id").cast("string").alias("part"), "date_time",
            F.col("value").cast("double").alias("value"),
            F.col("real_value").cast("double").alias("real_value"), "error",
        )

    def buckets(name: str) -> DataFrame:
        return stored.read(name).unpivot(
            ["building_code", "data_time"], list(SUBENTRY_BUCKETS), "part", "amount"
        ).select(
            F.lit(name).alias("table_name"), F.col("building_code").alias("code"), "part",
            F.col("data_time").alias("date_time"), F.col("amount").cast("double").alias("value"),
            zero.alias("real_value"), F.lit(0).alias("error"),
        )

    state = stored.state(stored.newest_batch("state")).select(
        F.lit("state").alias("table_name"), F.col("item_name").alias("code"),
        F.col("type_id").cast("string").alias("part"), "date_time",
        F.col("real_value").cast("double").alias("value"), zero.alias("real_value"),
        F.lit(0).alias("error"),
    )
    days = sorted({r.day for r in stored.read("hour").select("day").distinct().collect()})
    hours = stored.hours(days).unionByName(stored.read("virtual_hour"))
    parts = [
        energy("hour", hours), energy("day", stored.read("day")),
        energy("month", stored.read("month")), buckets("subentry_hour"),
        buckets("subentry_day"),
    ] + [state] * with_state
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def pipeline_live(spark, sf):
    root = scratch(spark, "live")
    d = views.meter_dimensions(spark, sf)

    def start():
        return live.start_live(
            _records(spark, f"{root}/records"), f"{root}/tables", f"{root}/checkpoint", d, P.NOW,
            position="offset", trigger=ONCE,
        )

    # What third parties report for hours that the readings have not reached stays pending.
    reported = views.queue(spark, sf).where(F.col("type") != work_queue.OWN)
    stored = MeterTables(spark, f"{root}/tables").create()
    stored.report(reported, 0)
    _drain(spark, sf, f"{root}/records", start)
    marks = stored.read("marks").select(
        F.lit("marks").alias("table_name"),
        F.concat_ws("_", "build_code", "collector_code").alias("code"),
        F.col("timestamp").alias("part"), times.stamp_to_hour(F.col("timestamp")).alias("date_time"),
        F.lit(0.0).alias("value"), F.lit(0.0).alias("real_value"), F.lit(0).alias("error"),
    )
    return _all_tables(stored).unionByName(marks)


def _arrived(spark: SparkSession, sf: str, name: str) -> MeterTables:
    """Hours, state, queue and ids of the live job over all arrivals, without derived tables."""
    root = scratch(spark, name)
    d = views.meter_dimensions(spark, sf)

    def start():
        return live.start_live(
            _records(spark, f"{root}/records"), f"{root}/tables", f"{root}/checkpoint", d, P.NOW,
            position="offset", trigger=ONCE, refresh=False, ids=True,
        )

    _drain(spark, sf, f"{root}/records", start)
    return MeterTables(spark, f"{root}/tables")


@query
def write_counts(spark, sf):
    """How many rows each arrival wrote."""
    counted = _arrived(spark, sf, "counts").read("writes")
    return counted.where(F.col("table_name").isin("hour", "queue", "state"))


@query
def stream_ids(spark, sf):
    return _arrived(spark, sf, "ids").read("ids").drop("batch")


@query
def state_changelog(spark, sf):
    """The state after batches of a few days that each log the series they touched."""
    part = F.date_trunc("week", "reading_ts")
    clean_rows = _stored(_clean(spark, sf).withColumn("part", part), "clean")
    stored = MeterTables(spark, scratch(spark, "log"), snapshot_every=3).create()
    parts = [r.part for r in clean_rows.select("part").distinct().orderBy("part").collect()]
    for n, week in enumerate(parts):
        rows = clean_rows.where(F.col("part") == week).drop("part")
        amounts = hourly.with_limits(hourly.hour_firsts(rows), _limits(spark, sf))
        stored.write_changes(hourly.last_known(amounts, stored.state(n - 1, only=amounts)), n)
    return as_double(stored.state(len(parts)))


@query
def pipeline_backfill(spark, sf):
    """Stores the history by day, then recomputes everything from it."""
    return _all_tables(_backfilled(spark, sf, []))


@query
def pipeline_backfill_overlap(spark, sf):
    """A run inside another, and one that overlaps both: the tables of one run over all times."""
    return _all_tables(_backfilled(spark, sf, [(P.FROM, P.TO), (P.SPLIT, P.NOW)]))


@query
def backfill_resume(spark, sf):
    """Two steps of one run with a third left out between them, then what resuming finds missing."""
    stored, history, first = _history(spark, sf)
    d = views.meter_dimensions(spark, sf)
    options = {"now": P.NOW, "position": "event_id"}
    backfill(stored, history, d, first, P.FROM, step=0, **options)
    backfill(stored, history, d, P.TO, P.NOW, step=2, **options)
    resume(stored, history, d, first, P.NOW, **options)
    if stored.missing(first, P.NOW):
        raise AssertionError("resuming left a part out")
    return _all_tables(stored, with_state=False)


def _backfilled(spark: SparkSession, sf: str, again: list[tuple[str, str]]) -> MeterTables:
    """The tables of a backfill over all stored days, and of more backfills after it."""
    stored, history, first = _history(spark, sf)
    for start, end in [(first, P.NOW), *again]:
        backfill(
            stored, history, views.meter_dimensions(spark, sf), start, end, P.NOW,
            position="event_id",
        )
    return stored


def _history(spark: SparkSession, sf: str) -> tuple[MeterTables, DataFrame, str]:
    """Empty tables, the stored history by day, and where it begins."""
    root = scratch(spark, "backfill")
    good, _ = clean.quarantine_split(views.readings(spark, sf), P.NOW)
    tables.replace_partitions(sources.with_day(good), f"{root}/history", ["day"])
    history = spark.read.parquet(f"{root}/history")
    first = history.agg(F.min("day")).first()[0]
    return MeterTables(spark, f"{root}/tables"), history, f"{first} 00:00:00"
