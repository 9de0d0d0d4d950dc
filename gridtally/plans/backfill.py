"""Recomputing a past time range from the stored history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions import times
from gridtally.functions.times import is_valid_range
from gridtally.operators import hourly
from gridtally.operators.clean import clean_readings
from gridtally.operators.dims import Dimensions
from gridtally.operators.queue import data_access_events, events_of_hour_rows
from gridtally.plans.tables import BACKFILL, STEPS, MeterTables
from gridtally.sources.readings import history_range_scan


def backfill(
    tables: MeterTables,
    history: DataFrame,
    dims: Dimensions,
    start: str,
    end: str,
    now: datetime | str | None = None,
    position: str | None = None,
    step: int = 0,
    queue_from: str = "readings",
    run: int | None = None,
    seed_from: str | None = None,
) -> int:
    """Computes every result table for the readings in ``[start, end)``; the run's number.

    The whole range is one plan, not a loop over hours. A run has its own partitions of the
    hour, queue and state tables, so ranges of different runs may overlap: inside its range
    the later run counts, outside it nothing changes. A long range can be cut into steps of
    one run; step ``n`` continues from the state that step ``n - 1`` left, and one that failed
    is simply run again. Without a number, step 0 begins a new run and a later step goes on
    with the newest. States of a backfill are apart from those of the live job.

    Step 0 takes the last reading of every series before ``start`` from the history, so the
    row across ``start`` is computed like any other; ``seed_from`` bounds how far it looks.

    Virtual items are computed for the collectors and hours that any reading touched, or
    with ``queue_from="hour_rows"`` only where an own meter got an hour row.
    """
    if not is_valid_range(start, end):
        raise ValueError(f"not a time range: {start} to {end}")
    if not 0 <= step < STEPS:
        raise ValueError(f"not a step: {step}")
    tables.create()
    if run is None:
        run = tables.next_run() - (step > 0)
    batch = BACKFILL + run * STEPS + step
    readings = history_range_scan(history, start, end)
    clean = clean_readings(readings, dims.item_type, now, position=position)
    amounts = hourly.with_limits(hourly.hour_firsts(clean), dims.limits)
    # Hour rows and state both read the amounts; a written table outlives lost executors.
    tables.replace("amounts", amounts.withColumn("batch", F.lit(batch)),
                   tables.spark.createDataFrame([(batch,)], "batch long"))
    amounts = tables.read("amounts").where(F.col("batch") == batch).drop("batch")
    if step == 0:
        before = history_range_scan(history, seed_from or "0001-01-01 00:00:00", start)
        before = clean_readings(before, dims.item_type, now, position=position)
        before = hourly.with_limits(hourly.hour_firsts(before), dims.limits)
        # The batch of a step before the first is free: it belongs to no step.
        seed = BACKFILL - 1 - run
        tables.write_state(hourly.last_known(before, tables.state(seed).limit(0)), seed)
    else:
        seed = batch - 1
    state = tables.state(seed)
    if queue_from == "hour_rows":
        queue = events_of_hour_rows(emitted(amounts, state))
    else:
        queue = data_access_events(readings, now)
    tables.write_hours(emitted(amounts, state), batch)
    tables.write_state(hourly.last_known(amounts, state), batch)
    tables.write_queue(queue, batch)
    # The range hides older runs' rows from here on; it counts as done when all tables have it.
    tables.write_range(start, end, batch, refreshed=False)
    tables.refresh(dims, days_between(tables, batch, start, end))
    tables.write_range(start, end, batch)
    return run


def resume(
    tables: MeterTables, history: DataFrame, dims: Dimensions, start: str, end: str, **options,
) -> list[int]:
    """Backfills those parts of ``[start, end)`` that no finished step has computed; their runs.

    Steps that failed or were left out are found by subtracting the computed ranges, whatever
    runs they belong to. A part goes on for an hour beyond its end, so that the row across it is
    there: the step after it did not know the reading before. ``options`` are those of ``backfill``.
    """
    tables.create()
    return [
        backfill(tables, history, dims, since, until, **options)
        for since, until in tables.missing(start, end, beyond=1)
    ]


def days_between(tables: MeterTables, batch: int, start: str, end: str) -> list:
    """The days a step wrote to, and those of its range that hold hour rows of other runs."""
    since, until = (F.to_date(times.parse_time(F.lit(t))) for t in (start, end))
    held = tables.read("hour").where(F.col("day").between(since, until)).select("day").distinct()
    return sorted({r.day for r in held.collect()} | set(tables.touched_days(batch)))


def emitted(amounts: DataFrame, state: DataFrame) -> DataFrame:
    """Hour rows of one batch, continuing from a state."""
    return hourly.consecutive_hours(hourly.seed_with_state(amounts, state))
