"""Tables for intermediate results, in the folder that the driver and all executors see."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Writes rows under a name and reads them back.
Store = Callable[[DataFrame, str], DataFrame]


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a session on one machine may do without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="gridtally-")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a new table: computed once, and safe from lost executors."""
    return stored_at(df, f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}")


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """The rows as the table at ``path``, in place of what it held; ``df`` must not read it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
