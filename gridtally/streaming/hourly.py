"""Hourly consumption as a stream, in two forms.

``hourly_stream`` is all Spark: a tumbling hour keeps the first reading, a two-hour window
that slides by one hour sees both ends of every step. State is the open hours only.
``hourly_fold`` keeps the last hour of every series in arbitrary state: it follows arrival
order, ignores late readings at once and can continue from a stored state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridtally.functions import text, times
from gridtally.operators.clean import typed_readings
from gridtally.operators.hourly import arrival_order
from gridtally.schemas import (
    AMOUNT, COEFFICIENT, DEFAULT_COEFFICIENT, DEFAULT_MAX_VALUE, FUTURE_TOLERANCE_SECONDS,
    HOUR_COLUMNS, SERIES_KEY,
)

HOUR_MICROS = 3_600_000_000


def timed_readings(
    readings: DataFrame,
    item_types: DataFrame,
    now: datetime | str | None = None,
    tolerance_seconds: int = FUTURE_TOLERANCE_SECONDS,
    position: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """``clean_readings`` for a stream.

    The watermark moves with every record whose time is valid, also one that is dropped
    later for its status or medium. Each batch reports how many readings it kept as the
    observed metric ``clean_readings``; Spark itself reports those behind the watermark.
    """
    rows = typed_readings(readings, position).where(
        times.not_in_future(F.col("reading_ts"), now, tolerance_seconds)
    )
    if delay is not None:
        rows = rows.withWatermark("reading_ts", delay)
    media = item_types.select(
        F.col("code").alias("param_id"), F.col("id").cast("int").alias("type_id"),
        F.col("basic_code").alias("type"),
    )
    name = text.item_name(F.col("building_id"), F.col("gate_id"), F.col("meter_id"))
    return (
        rows.where((F.col("status") == "0") & F.col("register").isNotNull())
        .withColumn("item_name", name)
        .where(F.col("item_name").isNotNull())
        .join(media, "param_id")
        .observe("clean_readings", F.count(F.lit(1)).alias("rows"))
    )


def hourly_stream(
    readings: DataFrame,
    item_types: DataFrame,
    limits: DataFrame,
    now: datetime | str | None = None,
    delay: str = "2 hours",
    position: str | None = None,
) -> DataFrame:
    """Append-mode stream of hour rows; a step is emitted once the watermark passes it.

    A reading that is late but within ``delay`` still counts.
    """
    timed = timed_readings(readings, item_types, now, position=position, delay=delay)
    order = arrival_order(F.col("reading_ts"), F.col("pos"))
    firsts = timed.groupBy(
        F.window("reading_ts", "1 hour").alias("w"), "item_name", "type_id", "type"
    ).agg(F.min_by("register", order).alias("register"))
    firsts = firsts.select(
        F.window_time("w").alias("t"), F.col("w.start").alias("hour"), *SERIES_KEY, "type",
        "register",
    )
    steps = firsts.groupBy(
        F.window("t", "2 hours", "1 hour").alias("w"), *SERIES_KEY, "type"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("register", "hour").alias("before"),
        F.max_by("register", "hour").alias("after"),
    ).where(F.col("n") == 2)
    known = limits.select(*SERIES_KEY, "max_value", "coefficient")
    ratio = F.coalesce("coefficient", F.lit(DEFAULT_COEFFICIENT)).cast(COEFFICIENT)
    top = F.coalesce("max_value", F.lit(DEFAULT_MAX_VALUE)).cast(AMOUNT)
    delta = F.col("amount") - F.col("prev_amount")
    return (
        steps.join(known, SERIES_KEY, "left")
        .withColumn("amount", (F.col("after") * ratio).cast(AMOUNT))
        .withColumn("prev_amount", (F.col("before") * ratio).cast(AMOUNT))
        .select(
            *SERIES_KEY, F.col("w.start").alias("date_time"),
            F.greatest(delta, F.lit(0)).cast(AMOUNT).alias("value"),
            F.col("amount").alias("real_value"),
            F.lit(0).cast(AMOUNT).alias("rate"),
            F.when((delta >= 0) & (delta < top), 0).otherwise(2).alias("error"),
            "type",
        )
        .select(*HOUR_COLUMNS)
    )


FOLD_OUTPUT = (
    "item_name string, type_id int, hour_us long, value decimal(31,10),"
    " real_value decimal(31,10), error int, type string"
)
FOLD_STATE = "hour_us long, amount decimal(31,10)"


def _fold(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Advances one series by the readings of one micro-batch.

    The chunks are reduced to the first reading of each hour as they come.
    """
    firsts: dict[int, tuple] = {}
    seed = None
    for chunk in chunks:
        if seed is None and pd.notna(chunk["seed_us"].iloc[0]):
            seed = (int(chunk["seed_us"].iloc[0]), chunk["seed_amount"].iloc[0])
        ordered = chunk.sort_values(["ts_us", "pos"]).drop_duplicates("hour_us")
        for r in ordered.itertuples():
            found = (r.ts_us, r.pos, r.amount, r.max_value, r.type)
            if r.hour_us not in firsts or found[:2] < firsts[r.hour_us][:2]:
                firsts[r.hour_us] = found
    last = state.get if state.exists else seed
    out = []
    for hour in sorted(firsts):
        _, _, amount, top, kind = firsts[hour]
        if last is not None and hour <= last[0]:
            continue
        if last is not None and hour - last[0] == HOUR_MICROS:
            delta = amount - last[1]
            error = 0 if 0 <= delta < top else 2
            out.append((*key, last[0], max(delta, Decimal(0)), amount, error, kind))
        last = (hour, amount)
    state.update(last)
    names = [f.split()[0] for f in FOLD_OUTPUT.split(", ")]
    yield pd.DataFrame(out, columns=names)


#: Series and hours that a task holds before it hands their first readings on.
HELD = 100_000
FOLD_ORDER = ["hour_us", "ts_us", "pos"]


def _firsts(schema: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Reduces a task's rows to the first one of every series and hour, in bounded memory."""
    key = [*SERIES_KEY, "hour_us"]
    names = [f.split()[0] for f in schema.split(", ")]

    def reduce(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for chunk in chunks:
            both = chunk if held is None else pd.concat([held, chunk])
            held = both.sort_values(FOLD_ORDER).drop_duplicates(key)
            if len(held) > HELD:
                yield held[names]
                held = None
        if held is not None:
            yield held[names]

    return reduce


def hourly_fold(
    readings: DataFrame,
    item_types: DataFrame,
    limits: DataFrame,
    state: DataFrame | None = None,
    now: datetime | str | None = None,
    position: str | None = None,
) -> DataFrame:
    """Append-mode stream of hour rows in arrival order, seeded from ``state`` if given.

    Readings are reduced before they are grouped: a series' group gets one row per hour and task,
    not all of its readings, so a meter with a third of them is no heavier than its hours.
    """
    timed = timed_readings(readings, item_types, now, position=position)
    known = limits.select(*SERIES_KEY, "max_value", "coefficient")
    ratio = F.coalesce("coefficient", F.lit(DEFAULT_COEFFICIENT)).cast(COEFFICIENT)
    rows = timed.join(known, SERIES_KEY, "left").select(
        *SERIES_KEY, "type", "pos",
        F.unix_micros("reading_ts").alias("ts_us"),
        F.unix_micros(times.hour_of(F.col("reading_ts"))).alias("hour_us"),
        (F.col("register") * ratio).cast(AMOUNT).alias("amount"),
        F.coalesce("max_value", F.lit(DEFAULT_MAX_VALUE)).cast(AMOUNT).alias("max_value"),
    )
    if state is None:
        rows = rows.withColumn("seed_us", F.lit(None).cast("long")).withColumn(
            "seed_amount", F.lit(None).cast(AMOUNT)
        )
    else:
        seeds = state.select(
            *SERIES_KEY, F.unix_micros("date_time").alias("seed_us"),
            F.col("real_value").cast(AMOUNT).alias("seed_amount"),
        )
        rows = rows.join(seeds, SERIES_KEY, "left")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows = rows.mapInPandas(_firsts(schema), schema)
    folded = rows.groupBy(*SERIES_KEY).applyInPandasWithState(
        _fold, FOLD_OUTPUT, FOLD_STATE, "append", GroupStateTimeout.NoTimeout
    )
    return folded.select(
        *SERIES_KEY, F.timestamp_micros("hour_us").alias("date_time"), "value", "real_value",
        F.lit(0).cast(AMOUNT).alias("rate"), "error", "type",
    ).select(*HOUR_COLUMNS)
