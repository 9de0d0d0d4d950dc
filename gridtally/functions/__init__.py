"""Column expressions; everything here stays inside the JVM but compiling a formula."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns whose expressions run once per row.

    Catalyst pushes a filter on a derived column below the projection and copies the
    expression into it, so a parsed time would be parsed for every condition on it and again
    for the output. Filters stop at a generator; this one makes exactly one row of each.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))
