"""Stream of raw records to the history and quarantine tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtally.operators.clean import flag_quarantine
from gridtally.sources.readings import decode_readings, with_day

HISTORY, QUARANTINE = "history", "quarantine"


def write_batch(records: DataFrame, batch: int, root: str, now: datetime | str | None) -> None:
    """One micro-batch, parsed once, into both tables.

    Every batch owns its ``batch`` partition and overwrites it, so a batch that runs again
    after a failure leaves the tables as they were.
    """
    flagged = flag_quarantine(decode_readings(records, raw="raw"), now)
    flagged = with_day(flagged).withColumn("batch", F.lit(batch))
    # Only a quarantined record's text says what it was.
    flagged = flagged.withColumn("raw", F.when(F.col("quarantined"), F.col("raw")))
    flagged = flagged.withColumn(
        "kind", F.when(F.col("quarantined"), QUARANTINE).otherwise(HISTORY)
    ).drop("quarantined")
    # One write, split by its first partition column: the records are read and parsed once.
    # Rebalanced, so that a batch makes a file per day and kind, and more only for large ones.
    (
        flagged.hint("rebalance", "kind", "day").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("kind", "day", "batch")
        .parquet(root)
    )


def start_ingest(
    records: DataFrame,
    root: str,
    checkpoint: str,
    now: datetime | str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Runs ``write_batch`` on every micro-batch of a record stream (column ``value``)."""
    return (
        records.writeStream.foreachBatch(lambda df, batch: write_batch(df, batch, root, now))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
