"""The live computation: every micro-batch extends the stored tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gridtally.operators import hourly
from gridtally.operators.clean import clean_readings
from gridtally.operators.dims import Dimensions
from gridtally.operators.queue import data_access_events
from gridtally.plans.backfill import emitted
from gridtally.plans.tables import MeterTables
from gridtally.sources.readings import decode_readings


def process_batch(
    records: DataFrame,
    batch: int,
    tables: MeterTables,
    dims: Dimensions,
    now: datetime | str | None = None,
    position: str | None = None,
    refresh: bool = True,
    ids: bool = False,
) -> None:
    """One micro-batch: hour rows, state, queue and marks, then the tables derived from them.

    The batch reads the state of the series it touches and writes what became of them, and it
    owns its ``batch`` partitions, so a replay after a failure repeats the same writes. Reports of
    third parties (``MeterTables.report``) are counted once the readings have reached their hour.
    With ``refresh`` off, run ``MeterTables.refresh`` for the touched days on a schedule. With
    ``ids``, series are numbered as they first appear. How many rows the batch wrote to each
    table is stored as the table ``writes``.
    """
    readings = decode_readings(records)
    clean = clean_readings(readings, dims.item_type, now, position=position)
    # A row per series and hour of the batch, kept for the hour rows and the state.
    amounts = hourly.with_limits(hourly.hour_firsts(clean), dims.limits).persist()
    try:
        state = tables.state(batch - 1, only=amounts)
        tables.write_hours(emitted(amounts, state), batch)
        tables.write_changes(hourly.last_known(amounts, state), batch)
        tables.write_queue(data_access_events(readings, now), batch)
        if ids:
            tables.write_ids(amounts, batch)
    finally:
        amounts.unpersist()
    tables.settle(batch)
    days = tables.touched_days(batch) if refresh else []
    tables.refresh(dims, days)
    tables.write_counts(batch, days)


def start_live(
    records: DataFrame,
    root: str,
    checkpoint: str,
    dims: Dimensions | Callable[[], Dimensions],
    now: datetime | str | None = None,
    position: str | None = None,
    trigger: dict | None = None,
    refresh: bool = True,
    ids: bool = False,
) -> StreamingQuery:
    """Runs ``process_batch`` on every micro-batch of a record stream (column ``value``).

    Dimensions that change while the job runs are given as a function, called for every batch:
    it reads the tables anew, so new meters, limits and formulas count from the next batch on.
    """
    MeterTables(records.sparkSession, root).create()

    def process(df: DataFrame, batch: int) -> None:
        tables = MeterTables(df.sparkSession, root)
        known = dims() if callable(dims) else dims
        process_batch(df, batch, tables, known, now, position, refresh, ids)

    return (
        records.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
