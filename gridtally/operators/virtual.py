"""Virtual meters: hour rows computed by formula from other meters' hour rows."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtally.functions import formula, numbers, text, times
from gridtally.operators import formula_graph
from gridtally.operators.queue import OWN
from gridtally.schemas import AMOUNT, DEFAULT_MAX_VALUE, HOUR_COLUMNS, HOUR_KEY
from gridtally.sources.shared import Store, stored

DECIMALS = 2
METRICS = ("value", "real_value", "rate")


def definitions(virtual_items: DataFrame) -> DataFrame:
    """Virtual items with their formula in compiled form."""
    return virtual_items.select(
        "item_name", "type_id", "type", "building_code", "collector_code",
        F.coalesce("max_value", F.lit(DEFAULT_MAX_VALUE)).cast("double").alias("max_value"),
        formula.compile_formula("formula").alias("postfix"),
    )


def formula_inputs(compiled: DataFrame, item_codes: DataFrame) -> DataFrame:
    """One row per virtual item and item it reads; ids that name no item drop out."""
    refs = compiled.select(
        "item_name", "type_id", "type",
        F.explode(formula.referenced_items(F.col("postfix"))).alias("item_id"),
    )
    sources = item_codes.select(
        "item_id", F.col("item_name").alias("source_name"), F.col("type_id").alias("source_type_id")
    )
    return refs.join(sources, "item_id")


def dependencies(compiled: DataFrame, inputs: DataFrame) -> DataFrame:
    """The inputs that are virtual items themselves, on the side of the item that reads them."""
    virtual = compiled.select(
        F.col("item_name").alias("source_name"), F.col("type_id").alias("source_type_id"),
        F.col("type").alias("source_type"),
    )
    return (
        inputs.join(virtual, formula_graph.SOURCE).where(_same_side()).select(*formula_graph.EDGE)
    )


def _same_side() -> Column:
    return text.is_electric(F.col("type")) == text.is_electric(F.col("source_type"))


class Formulas(NamedTuple):
    """Compiled items, the items they read, and the levels in which they are computed."""

    compiled: DataFrame
    inputs: DataFrame
    order: list[DataFrame]


def formulas(
    virtual_items: DataFrame, item_codes: DataFrame, store: Store = stored
) -> Formulas:
    """What all computations with the same formulas share, compiled and put in order once."""
    compiled = store(definitions(virtual_items), "formulas")
    inputs = store(formula_inputs(compiled, item_codes), "inputs")
    order = formula_graph.levels(compiled, dependencies(compiled, inputs), store)
    return Formulas(compiled, inputs, order)


_formulas = formulas  # under a name that no parameter hides


def virtual_hour(
    hour_rows: DataFrame, virtual_items: DataFrame, item_codes: DataFrame, queue: DataFrame,
    store: Store = stored, formulas: Formulas | None = None,
) -> DataFrame:
    """Hour rows of virtual items, also of those whose formulas read virtual items.

    A row appears for an hour when the item's own collector is queued (type own) for the next
    hour and at least one input has a valid row. A result that no amount can hold counts as
    0, like that of a faulty formula, and is never valid. Inputs come from the item's own side,
    electric or not; a missing input is 0. The inputs of one formula and hour are grouped
    into a map, which is as large as the formula is long.

    Items are computed level by level, one join each, so that every input is there before it is
    read. Items that read themselves, directly or by way of others, have no rows. ``store`` keeps
    the rows of a level for the next; where no formula reads a virtual item it is not used.
    ``formulas`` are those of the items and codes if they were compiled before.
    """
    if formulas is None:
        compiled = definitions(virtual_items)
        inputs = formula_inputs(compiled, item_codes)
        order = formula_graph.levels(compiled, dependencies(compiled, inputs), store)
    else:
        compiled, inputs, order = formulas
    if len(order) == 1:
        mine = compiled.join(order[0], formula_graph.NODE, "left_semi")
        return _level(hour_rows, mine, inputs, queue)
    if formulas is None:  # what every level reads again
        compiled, inputs = store(compiled, "formulas"), store(inputs, "inputs")
    queue = store(queue.where(F.col("type") == OWN).distinct(), "due")
    made: list[DataFrame] = []
    known = hour_rows.select(*HOUR_COLUMNS)
    for n, items in enumerate(order):
        mine = compiled.join(items, formula_graph.NODE, "left_semi")
        made.append(store(_level(known, mine, inputs, queue), f"virtual_level{n}"))
        known = known.unionByName(made[-1])
    return reduce(DataFrame.unionByName, made)


class Propagated(NamedTuple):
    """All virtual rows after a change, the keys that were computed again, and their rows."""

    rows: DataFrame
    dirty: DataFrame
    computed: DataFrame


def propagate(
    stored_rows: DataFrame, changed: DataFrame, hour_rows: DataFrame, virtual_items: DataFrame,
    item_codes: DataFrame, queue: DataFrame, newly_due: DataFrame, store: Store = stored,
    formulas: Formulas | None = None,
) -> Propagated:
    """What ``virtual_hour`` gives after a change, computed only where the change reaches.

    ``stored_rows`` are its rows from before, ``changed`` the keys (item, type, hour) of the hour rows
    that came, went or moved since, ``newly_due`` the queue rows that came; the other tables are as
    they are now, with the same formulas as before. A changed key makes those items dirty at its
    hour that read it, these make dirty what reads them, level by level; newly queued collectors
    make their items dirty. Only dirty keys are computed, from the hours that hold any, and stored rows
    stand in for inputs that are not. ``formulas`` are as in ``virtual_hour``.
    """
    compiled, inputs, order = formulas or _formulas(virtual_items, item_codes, store)
    queue = store(queue.where(F.col("type") == OWN).distinct(), "due")
    due = store(
        compiled.join(_due_hours(newly_due), ["building_code", "collector_code"])
        .select(*HOUR_KEY).distinct(), "newly_due",
    )
    moved = store(changed.select(*HOUR_KEY).distinct(), "changed")
    touched = moved.select("date_time").unionByName(due.select("date_time")).distinct()
    own = hour_rows.select(*HOUR_COLUMNS).join(touched, "date_time", "left_semi")
    known, old = own.select(*HOUR_COLUMNS), stored_rows.select(*HOUR_COLUMNS)
    dirty, computed = [], []
    for n, items in enumerate(order):
        mine = compiled.join(items, formula_graph.NODE, "left_semi")
        sources = reduce(DataFrame.unionByName, [moved, *dirty]).select(
            F.col("item_name").alias("source_name"), F.col("type_id").alias("source_type_id"), "date_time")
        reached = inputs.join(sources, formula_graph.SOURCE).select(*HOUR_KEY)
        at = reached.unionByName(due).join(items, formula_graph.NODE, "left_semi").distinct()
        dirty.append(store(at, f"dirty{n}"))
        computed.append(store(_level(known, mine, inputs, queue, dirty[-1]), f"computed{n}"))
        # What this level's items are at the touched hours, for the levels above.
        still = old.join(items, formula_graph.NODE, "left_semi").join(touched, "date_time", "left_semi")
        still = still.select(*HOUR_COLUMNS).join(dirty[-1], HOUR_KEY, "left_anti")
        known = known.unionByName(still.select(*HOUR_COLUMNS)).unionByName(computed[-1])
    again, made = (reduce(DataFrame.unionByName, x) for x in (dirty, computed))
    kept = old.join(again, HOUR_KEY, "left_anti").select(*HOUR_COLUMNS)
    return Propagated(kept.unionByName(made), again, made)


def _due_hours(queue: DataFrame) -> DataFrame:
    """Collectors and the hours that their virtual items are due for."""
    return queue.where(F.col("type") == OWN).select(
        F.col("build_code").alias("building_code"), "collector_code",
        (times.stamp_to_hour(F.col("timestamp")) - times.hours(1)).alias("date_time"),
    ).distinct()


def _level(
    hour_rows: DataFrame, compiled: DataFrame, inputs: DataFrame, queue: DataFrame,
    only: DataFrame | None = None,
) -> DataFrame:
    """Hour rows of items whose inputs all are among ``hour_rows``; of some keys only if given."""
    inputs = inputs.join(compiled.select(*formula_graph.NODE), formula_graph.NODE, "left_semi")
    valid = hour_rows.where(F.col("error") == 0).select(
        F.col("item_name").alias("source_name"), F.col("type_id").alias("source_type_id"),
        "date_time", F.col("type").alias("source_type"),
        F.struct(*[F.col(m).cast("double").alias(m) for m in METRICS]).alias("amounts"),
    )
    read = valid.join(inputs, formula_graph.SOURCE).where(_same_side())
    if only is not None:
        read = read.join(only, HOUR_KEY, "left_semi")
    gathered = (
        read.groupBy("item_name", "type_id", "date_time")
        .agg(F.map_from_entries(F.collect_list(F.struct("item_id", "amounts"))).alias("inputs"))
    )
    due = _due_hours(queue)

    def result(metric: str):
        inputs = F.transform_values("inputs", lambda _, amounts: amounts[metric])
        return numbers.round_half_up(formula.evaluate(F.col("postfix"), inputs), DECIMALS)

    computed = (
        gathered.join(compiled, ["item_name", "type_id"])
        .join(due, ["building_code", "collector_code", "date_time"], "left_semi")
        .select(
            "item_name", "type_id", "date_time", "type", "max_value",
            *[result(m).alias(m) for m in METRICS],
        )
    )
    in_range = (F.col("value") >= 0) & (F.col("value") <= F.col("max_value"))

    def amount(x):
        return F.coalesce(x.try_cast(AMOUNT), F.lit(0).cast(AMOUNT))

    return computed.select(
        "item_name", "type_id", "date_time",
        amount(F.greatest("value", F.lit(0.0))).alias("value"),
        amount(F.col("real_value")).alias("real_value"),
        amount(F.col("rate")).alias("rate"),
        F.when(in_range, 0).otherwise(2).alias("error"),
        "type",
    ).select(*HOUR_COLUMNS)


def changes(new_rows: DataFrame, stored: DataFrame) -> DataFrame:
    """New virtual rows that are not stored yet or whose value moved, with the change."""
    old = stored.select(
        *HOUR_KEY, *[F.col(m).alias(f"old_{m}") for m in METRICS], F.lit(True).alias("known")
    )
    joined = new_rows.join(old, HOUR_KEY, "left").select(
        *HOUR_COLUMNS,
        F.col("known").isNull().alias("is_new"),
        *[(F.col(m) - F.coalesce(f"old_{m}", F.lit(0))).cast(AMOUNT).alias(f"change_{m}")
          for m in METRICS],
    )
    return joined.where(F.col("is_new") | (F.col("change_value") != 0))
