"""Metering tables derived from the supplied parquet tables.

Readings come from ``events``: ten meters in five buildings, one medium per event type.
The registers are running totals per series. They are built in two levels, per minute
and within the minute, so no task ever sorts a whole series.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtally.functions import compute_once
from gridtally.operators import queue as work_queue
from gridtally.operators.dims import Dimensions
from gridtally.schemas import READING_FIELDS
from gridtally.sources.shared import stored_at
from workload.params import MEDIA, NESTED, NOW, SUBENTRY_CODES, UNKNOWN_CODE, VIRTUALS
from workload.session import scratch

INT, TEXT, REAL = pa.int32(), pa.string(), pa.float64()
MEDIA_COLUMNS = {"id": INT, "code": TEXT, "basic_code": TEXT, "table_name": TEXT}


def literal(spark: SparkSession, rows: list[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """Fixed rows as a local relation, whose size Catalyst knows."""
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows), columns.values())]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type",
        (F.col("user_id") % 10).alias("x"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
        F.col("value").cast("decimal(18,2)").alias("d"),
    )


def _medium_code():
    code = F.lit(UNKNOWN_CODE)
    for event_type, _, medium, *_ in MEDIA:
        code = F.when(F.col("event_type") == event_type, F.lit(medium)).otherwise(code)
    return code


SERIES = ["x", "event_type", "minute"]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with the text fields of their readings, all but the registers."""
    k = F.col("k")
    e = events(spark, sf_dir).withColumn("minute", F.date_trunc("minute", "ts"))
    # Made once and before the shuffle, so that later filters see plain columns.
    return compute_once(e, {
        "building_id": F.concat(F.lit("B"), F.col("user_id") % 5),
        "gate_id": F.concat(F.lit("G"), F.col("user_id") % 2),
        "meter_id": F.concat(F.lit("M"), F.col("x")),
        "param_id": _medium_code(),
        "status": F.when(k % 10 == 0, "1").otherwise("0"),
        "ts_str": F.when(k == 37, "20171009131B00").when(k == 47, F.lit(None))
        .when(k % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyyMMddHHmmss")),
    }).drop("user_id")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where and when readings came from: those of ``readings``, without the work for registers.

    A reading has a register when all parts of its series are known.
    """
    known = [F.col(c).isNotNull() for c in SERIES]
    return _texts(spark, sf_dir).where(known[0] & known[1] & known[2]).select(
        "building_id", "gate_id", "ts_str")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings, ten text fields and ``event_id`` as arrival position."""
    k = F.col("k")
    e = events(spark, sf_dir).withColumn("minute", F.date_trunc("minute", "ts"))
    earlier_minutes = (
        Window.partitionBy("x", "event_type").orderBy("minute")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = e.groupBy(*SERIES).agg(F.sum("d").alias("s")).select(
        *SERIES, F.coalesce(F.sum("s").over(earlier_minutes), F.lit(0)).alias("start")
    )
    in_minute = (
        Window.partitionBy(*SERIES).orderBy("ts", "event_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = (F.col("start") + F.sum("d").over(in_minute)).cast("decimal(28,2)")
    registers = _texts(spark, sf_dir).join(starts, SERIES).withColumn("total", total)
    register = F.when(F.col("event_type") == "view", F.col("d").cast("decimal(28,2)")).otherwise(
        F.col("total")
    )
    return registers.select(
        "*", F.lit("01").alias("type"), F.lit(None).cast("string").alias("name"),
        F.lit("kWh").alias("unit"),
        F.when(k == 7, "48,892.60").when(k == 17, F.lit(None)).when(k == 27, "NaN")
        .otherwise(register.cast("string")).alias("value"),
    ).select("event_id", *READING_FIELDS)


def nested_dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    """The same meters with virtual items that read virtual items, some of them in cycles."""
    items = [(i, code, place, kind, top, None, f) for i, code, place, kind, top, f in NESTED]
    return meter_dimensions(spark, sf_dir, items)


def meter_dimensions(
    spark: SparkSession, sf_dir: str, virtuals: list[tuple] | None = None
) -> Dimensions:
    """Dimensions of the meters seen in ``events``, plus virtual items, which are five if not given.

    ``virtuals`` has id, code, collector, data type, max value, sub-entry and formula.
    """
    if virtuals is None:
        virtuals = [(i, code, 1, kind, top, sub, f) for i, code, kind, top, sub, f in VIRTUALS]
    # A few rows that every lookup reads several times: stored, so the events are read once.
    seen = events(spark, sf_dir).select("x", "event_type").distinct()
    seen = stored_at(seen, scratch(spark, "seen"))
    xs = seen.select("x").distinct()
    media = literal(spark, MEDIA, {"event_type": TEXT, **MEDIA_COLUMNS})
    b = (F.col("x") % 5).cast("int")
    x = F.col("x").cast("int")
    building = xs.select(
        (b + 1).alias("id"), F.concat(F.lit("B"), b).alias("code")
    ).distinct()
    collector = xs.select(
        (x + 1).alias("id"), F.concat(F.lit("G"), x % 2).alias("code"),
        (b + 1).alias("building_id"),
    )
    item_type = seen.select("event_type").distinct().join(media, "event_type").drop("event_type")
    t = F.col("type_id")
    limit = (
        F.when(x == 0, F.lit(None)).when(x == 1, -1.0).when(x == 2, 50.0).otherwise(100.0)
    )
    ratio = (
        F.when(x == 3, F.lit(None)).when(x == 4, -1.0).when(x == 5, 2.0).otherwise(1.0)
    )
    physical = seen.join(media.select("event_type", F.col("id").alias("type_id")), "event_type").select(
        (1000 + 4 * x + (t - 11)).cast("int").alias("id"),
        F.concat(F.lit("M"), x).alias("code"), (x + 1).alias("collector_id"),
        t.alias("data_type"), limit.cast("double").alias("max_value"),
        ratio.cast("double").alias("coefficient"),
        F.when(t == 11, x % 6 + 1).cast("int").alias("subentry"),
    )
    virtual = literal(
        spark,
        [(i, code, place, kind, top, None, sub) for i, code, place, kind, top, sub, _ in virtuals],
        {"id": INT, "code": TEXT, "collector_id": INT, "data_type": INT,
         "max_value": REAL, "coefficient": REAL, "subentry": INT},
    )
    item_virtual = literal(
        spark, [(v[0], v[6]) for v in virtuals], {"item_id": INT, "formula": TEXT}
    )
    subentry = literal(spark, list(enumerate(SUBENTRY_CODES, 1)), {"id": INT, "code": TEXT})
    return Dimensions(
        building, collector, physical.unionByName(virtual), item_type, item_virtual, subentry
    )


def catalog_dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    """A large catalogue: buildings are nations, collectors suppliers, items the parts of a supplier."""
    building = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("code")
    )
    collector = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("code"),
        F.col("s_nationkey").alias("building_id"),
    )
    part = table(spark, sf_dir, "part")
    supplied = (
        table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    size = F.col("p_size")
    item_id = (F.col("l_suppkey") * 10_000_000_000 + F.col("l_partkey"))
    price = F.col("p_retailprice")
    item = supplied.select(
        item_id.alias("id"), F.col("l_partkey").cast("string").alias("code"),
        F.col("l_suppkey").alias("collector_id"),
        (11 + size % 4).cast("int").alias("data_type"),
        F.when(size == 1, F.lit(None)).when(size == 2, -1.0).otherwise(price).alias("max_value"),
        F.when(size == 3, F.lit(None)).when(size == 4, -1.0)
        .otherwise(size.cast("double")).alias("coefficient"),
        (size % 7 + 1).cast("int").alias("subentry"),
    )
    item_type = literal(spark, [m[1:] for m in MEDIA], MEDIA_COLUMNS)
    item_virtual = supplied.where(F.col("p_type") == "PROMO").select(
        item_id.alias("item_id"), F.concat(item_id.cast("string"), F.lit(" + d1")).alias("formula")
    )
    subentry = literal(spark, list(enumerate(SUBENTRY_CODES, 1)), {"id": INT, "code": TEXT})
    return Dimensions(building, collector, item, item_type, item_virtual, subentry)


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own rows of all readings; third-party rows for signups, of which errors are done."""
    e = events(spark, sf_dir)
    reported = e.where(F.col("event_type").isin("signup", "error")).select(
        F.concat(F.lit("B"), F.col("user_id") % 5).alias("build_code"),
        F.concat(F.lit("G"), F.col("user_id") % 2).alias("collector_code"),
        F.date_format("ts", "yyyyMMddHH").alias("timestamp"),
        F.when(F.col("event_type") == "signup", work_queue.THIRD_PARTY)
        .otherwise(work_queue.DONE).alias("type"),
    ).distinct()
    return work_queue.data_access_events(arrivals(spark, sf_dir), NOW).unionByName(reported)
