"""Mixing sources to target weights: repetition rates per source and hash-seeded copies.

Sizes are summed per source, a rate is derived for every source, and every document is taken
floor(rate) times plus once more with probability equal to the fraction. The draw is a hash of a
seed and the document's key, so reruns agree whatever the partitioning. Of DRAWS seeds a source
uses the one whose total comes nearest to its target; they are all summed in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtally.llm.common import n_words, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Seeds tried per source: four draws of 32 bits from each of these md5 sums.
SEEDS = (0, 1, 2, 3)
DRAWS = 4 * len(SEEDS)


def draws(key: Column) -> list[Column]:
    """DRAWS numbers in [0, 1) that depend only on the key and the seed."""
    name = F.coalesce(key.cast("string"), F.lit("null"))
    sums = [F.md5(F.concat(F.lit(f"{seed}:"), name)) for seed in SEEDS]
    return [
        F.conv(F.substring(s, 8 * i + 1, 8), 16, 10).cast("double") / 4294967296.0
        for s in sums for i in range(4)
    ]


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times all
    sizes. A target stops at ``most`` times its source's size, and the excess is shared again by
    weight. The sources that stop are those with the least room per weight: with sources in that
    order, one stops while its room is below its share of what the earlier ones leave. The windows
    without a key run over one row per source, never over documents.
    """
    if share > most:
        raise ValueError("a share above what all sources may give has no solution")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = per_source.withColumn(
        "w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")),
    ).withColumn("room", F.col("source_size") * float(most))
    order = Window.orderBy(
        (F.col("room") / F.col("w")).asc(), F.col("source").asc_nulls_last()
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        (F.sum("source_size").over(every) * float(share)
         - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    )
    full = weighed.withColumn("level", level).withColumn(
        "stops", F.col("room") < F.col("w") * F.col("level")
    )
    shared = F.min(F.when(~F.col("stops"), F.struct(F.col("room") / F.col("w"), "source", "level")))
    return full.withColumn("rest", shared.over(every).getField("level")).select(
        "source", "source_size",
        F.when(F.col("stops"), F.col("room")).otherwise(
            F.least(F.col("room"), F.col("w") * F.coalesce("rest", "level"))
        ).alias("target"),
    )


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source",
        size: Column | None = None, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(key, source, mix) with mix = (size, source_size, target, rate, copies, taken), a row per document.

    ``size`` is the number of words of ``text`` by default. Null text has size 0, a null source is a
    source of its own and the last, repeated rows draw alike, an empty table gives an empty one, and
    a source without words has rate 0. Other columns of ``docs`` are not read. The table of keys and
    sizes is stored, so texts are read once.
    """
    size = n_words(F.col("text")) if size is None else size
    sizes = stored(
        docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size.alias("size")),
        "sizes",
    )
    goals = targets(sizes, weights, share, most).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )
    goals = stored(goals, "targets")
    each = sizes.alias("d").join(goals.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))) \
        .select("d.*", "s.source_size", "s.target", "s.rate")
    whole, part = F.floor("rate"), F.col("rate") - F.floor("rate")
    totals = each.groupBy("source").agg(*[
        F.sum(F.when(u < part, F.col("size")).otherwise(0)).alias(f"t{k}")
        for k, u in enumerate(draws(F.col("key")))
    ])
    misses = F.array(*[
        F.struct(F.abs(F.col("target") - whole * F.col("source_size") - F.col(f"t{k}")).alias("miss"),
                 F.lit(k).alias("k"))
        for k in range(DRAWS)
    ])
    chosen = stored(
        goals.alias("s").join(totals.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select("s.*", F.array_min(misses).getField("k").alias("k")), "draws",
    )
    u = F.element_at(F.array(*draws(F.col("key"))), F.col("k") + 1)
    copies = (whole + F.when(u < part, 1).otherwise(0)).cast("long")
    return (
        sizes.alias("d").join(chosen.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select(
            F.col("key").alias(key), F.col("d.source").alias(source),
            F.struct("size", "source_size", "target", "rate", copies.alias("copies"),
                     (copies * F.col("size")).alias("taken")).alias("mix"),
        )
    )


def emit(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", source: str = "source") -> DataFrame:
    """Every document as often as the mix takes it, with the columns it came with.

    ``mixed`` is what ``mix`` made of the same documents. Repeated rows of one key and source draw
    alike, so each is emitted as often as the others.
    """
    copies = mixed.where("mix.copies > 0").groupBy(
        F.col(key).alias("__key"), F.col(source).alias("__source")
    ).agg(F.max("mix.copies").alias("__copies"))
    return (
        docs.join(copies, F.col(key).eqNullSafe(F.col("__key"))
                  & F.col(source).eqNullSafe(F.col("__source")))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
