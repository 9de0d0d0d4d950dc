"""Raw readings: JSON records from a stream or files, and the stored history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.functions import text, times
from gridtally.schemas import READING_FIELDS


def decode_readings(records: DataFrame, value: str = "value", raw: str | None = None) -> DataFrame:
    """Ten named text fields from a JSON array record; all null when it is malformed.

    Other columns of ``records`` are kept, and the record's own text as ``raw`` if named.
    """
    kept = [c for c in records.columns if c != value]
    if raw is not None:
        records, kept = records.withColumn(raw, F.col(value).cast("string")), [*kept, raw]
    cells = text.parse_json_array(F.col(value).cast("string"))
    return records.select(*kept, cells.alias("_cells")).select(
        *kept, *[F.get("_cells", F.lit(i)).alias(n) for i, n in enumerate(READING_FIELDS)]
    )


def encode_readings(readings: DataFrame, name: str = "value") -> DataFrame:
    """The inverse of ``decode_readings``: nulls stay JSON nulls."""
    kept = [c for c in readings.columns if c not in READING_FIELDS]
    record = F.to_json(F.array(*READING_FIELDS), {"ignoreNullFields": "false"})
    return readings.select(*kept, record.alias(name))


def history_range_scan(history: DataFrame, start: str, end: str) -> DataFrame:
    """Readings in ``[start, end)``.

    A history table stored by ``day`` is pruned to the days of the range, and only on its
    first and last day are the times of the rows looked at.
    """
    since, until = (times.parse_time(F.lit(t)) for t in (start, end))
    ts = times.parse_time(F.col("ts_str"))
    inside = (ts >= since) & (ts < until)
    if "day" in history.columns:
        first, last = F.to_date(since), F.to_date(until)
        day = F.col("day")
        return history.where(day.between(first, last)).where(
            ((day > first) & (day < last)) | inside
        )
    return history.where(inside)


def with_day(readings: DataFrame) -> DataFrame:
    """Adds the partition column of the history table."""
    return readings.withColumn("day", F.to_date(times.parse_time(F.col("ts_str"))))


def kafka_stream(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Records of one topic; offsets live in the query's checkpoint.

    A new query starts at ``starting_offsets``, "earliest", "latest" or the text that
    ``operators.offsets.as_json`` makes of offsets recorded elsewhere. Without ``fail_on_data_loss``, offsets that have aged out restart at the beginning.
    Needs the Kafka connector on the cluster's classpath.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")


def file_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Text files of one JSON record per line, oldest file first.

    All new files make one batch. A limit cuts them into several, in order of their
    modification times; set one only where older files hold no later readings, since a
    batch that runs ahead makes the watermark drop what the next one brings.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("value")
