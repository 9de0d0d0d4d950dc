"""What the operators share: words, tables in the shared folder, columns, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white space characters.
WORD = "[^\\x20\\x09-\\x0D]+"
WORDS = re.compile(WORD)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir.

    Only a session on one machine may do without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="llm-")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when their job ends, not when the driver collects its garbage.

    For jobs whose rows are stored: what is read again later is the table.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def n_words(text: Column) -> Column:
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(id, component_id) of every id in the edges (a, b); component_id is the smallest id reachable.

    Large-star and small-star in turn. Every step is an aggregate with map-side combine and an
    equi-join, so a node with a third of all edges is one partial row per task and a join that
    AQE splits. Null ends and loops are ignored; an empty table gives an empty one.
    """
    both = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct(), "edges",
    )
    seen = None
    for _ in range(max_rounds):
        large = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = large.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            large.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        both = stored(small, "edges")
        now = both.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return both.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(
        both.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    )
