"""The order in which formulas that read each other's results are computed.

Nodes are (item_name, type_id); an edge says that an item's formula reads another one. Levels come
from the leaves up: an item is ready once all that it reads are. What is left then reads itself by
way of others, or reads such an item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.sources.shared import Store, stored

NODE = ["item_name", "type_id"]
SOURCE = ["source_name", "source_type_id"]
EDGE = [*NODE, *SOURCE]


def _as_source(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("item_name").alias("source_name"), F.col("type_id").alias("source_type_id"))


def _as_node(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("source_name").alias("item_name"), F.col("source_type_id").alias("type_id"))


def levels(nodes: DataFrame, edges: DataFrame, store: Store = stored) -> list[DataFrame]:
    """The nodes of each level, from those without edges up; members of a cycle are in none.

    An edge from or to a cycle's member counts for nothing, so an item that reads one is computed
    as if that input were missing. One small job a level; the driver sees counts of edges.
    """
    nodes, edges = nodes.select(*NODE).distinct(), edges.select(*EDGE).distinct()
    if edges.isEmpty():
        return [nodes]
    nodes, edges = store(nodes, "nodes"), store(edges, "edges")
    found, rest = _peel(nodes, edges, store, "first")
    if rest is None:
        return found
    members = store(cycle_members(rest, store), "cycles")
    nodes = nodes.join(members, NODE, "left_anti")
    edges = edges.join(members, NODE, "left_anti").join(_as_source(members), SOURCE, "left_anti")
    return _peel(nodes, edges, store, "second")[0]


def _peel(
    nodes: DataFrame, edges: DataFrame, store: Store, name: str
) -> tuple[list[DataFrame], DataFrame | None]:
    """Levels from the leaves up, and the edges among and into cycles if there are any."""
    found: list[DataFrame] = []
    left = edges.count()
    while True:
        n = len(found)
        free = store(nodes.join(edges.select(*NODE).distinct(), NODE, "left_anti"), f"{name}_level{n}")
        found.append(free)
        if left == 0:
            return found, None
        nodes = nodes.join(free, NODE, "left_anti")
        edges = store(edges.join(_as_source(free), SOURCE, "left_anti"), f"{name}_edges{n}")
        before, left = left, edges.count()
        if left == before:
            return found, edges


def cycle_members(edges: DataFrame, store: Store = stored) -> DataFrame:
    """The nodes that reach themselves.

    Nodes that nothing reads or that read nothing go first, so only cycles and the ways between
    them are left. Reachability among those few is closed by doubling; it is as large as the
    square of a cycle's length, which is the number of faulty formulas that hang together.
    """
    edges = edges.select(*EDGE).distinct()
    before, n = None, 0
    while before != (now := edges.count()):
        before = now
        inner = edges.join(_as_source(edges.select(*NODE)).distinct(), SOURCE, "left_semi")
        inner = inner.join(_as_node(edges).distinct(), NODE, "left_semi")
        edges, n = store(inner, f"inner{n}"), n + 1
    reach, before = edges, None
    while before != (now := reach.count()):
        before = now
        onward = reach.select(
            F.col("item_name").alias("source_name"), F.col("type_id").alias("source_type_id"),
            F.col("source_name").alias("far_name"), F.col("source_type_id").alias("far_type_id"),
        )
        further = reach.join(onward, SOURCE).select(
            *NODE, F.col("far_name").alias("source_name"), F.col("far_type_id").alias("source_type_id")
        )
        reach, n = store(reach.unionByName(further).distinct(), f"reach{n}"), n + 1
    itself = (F.col("item_name") == F.col("source_name")) & (F.col("type_id") == F.col("source_type_id"))
    return reach.where(itself).select(*NODE).distinct()
