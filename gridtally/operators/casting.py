"""Declared column types: schema from a description, typed binding, conformance counts."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMAL = T.DecimalType(38, 10)

# Declared type name -> Spark type; any other name is text.
SPARK_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.IntegerType(),
    "short": T.ShortType(),
    "tiny": T.ShortType(),
    "bit": T.BooleanType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "money": T.DoubleType(),
    "numeric": DECIMAL,
    "decimal": DECIMAL,
    "datetime": T.TimestampType(),
    "smalldatetime": T.DateType(),
}

# Declared type name -> stored type name; any other name is upper-cased.
STORED_TYPES = {
    "int": "INTEGER",
    "numeric": "DECIMAL",
    "money": "DOUBLE",
    "datetime": "TIMESTAMP",
    "smalldatetime": "DATE",
    "char": "VARCHAR",
    "nchar": "VARCHAR",
    "varchar": "VARCHAR",
    "nvarchar": "VARCHAR",
    "text": "VARCHAR",
    "ntext": "VARCHAR",
    "bit": "BOOLEAN",
}

# The type names the conformance check knows; others never conform.
CHECKED_TYPES = [
    "bigint", "int", "short", "tiny", "bit", "float", "double", "money", "numeric", "decimal",
    "string",
]


def spark_type(name: str) -> T.DataType:
    return SPARK_TYPES.get(name, T.StringType())


def bind(cell: Column, type_name: str) -> Column:
    """A text cell as its declared type, null when it does not parse."""
    if type_name in ("short", "tiny"):  # parsed as a byte, so -128..127
        return cell.try_cast("tinyint").cast("smallint")
    if type_name == "bit":  # only the word true is true
        return F.lower(cell) == "true"
    return cell.try_cast(spark_type(type_name))


def cast_by_spec(cells: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Binds the text columns named in ``spec``, in its order."""
    return cells.select(*[bind(F.col(c), t).alias(c) for c, t in spec.items()])


def conforms(cell: Column, type_name: str) -> Column:
    if type_name == "string":
        return F.lit(True)
    if type_name not in CHECKED_TYPES:
        return F.lit(False)
    if type_name == "bit":
        return F.coalesce(F.lower(cell).isin("true", "false"), F.lit(False))
    return bind(cell, type_name).isNotNull()


def type_check(cells: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Per column of ``spec``: its type, the number of rows and how many conform (one pass)."""
    counts = cells.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(conforms(F.col(c), t)).alias(c) for c, t in spec.items()],
    )
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("declared"), F.col(c).alias("n_ok"))
        for c, t in spec.items()
    ])
    return counts.select("n_rows", F.explode(entries).alias("e")).select(
        F.col("e.column").alias("column_name"), F.col("e.declared").alias("declared_type"),
        "n_rows", F.col("e.n_ok").alias("n_ok"),
    )


def schema_from_spec(spec_json: str) -> tuple[T.StructType, list[str]]:
    """(columns, key) of one table description: ``columns`` name -> type, ``rowkey`` names."""
    spec = json.loads(spec_json)
    key = list(spec.get("rowkey") or [])
    fields = [T.StructField(c, spark_type(t), c not in key) for c, t in spec["columns"].items()]
    return T.StructType(fields), key


def empty_table(spark: SparkSession, spec_json: str) -> DataFrame:
    return spark.createDataFrame([], schema_from_spec(spec_json)[0])


def describe_tables(registry: DataFrame, spec: str) -> DataFrame:
    """Columns of every table description in a registry, one row each.

    ``spec`` names the column of JSON descriptions; the other columns are kept.
    """
    kept = [c for c in registry.columns if c != spec]
    parsed = registry.select(
        *kept,
        F.from_json(F.get_json_object(spec, "$.columns"), "map<string,string>").alias("_columns"),
        F.from_json(F.get_json_object(spec, "$.rowkey"), "array<string>").alias("_key"),
    )
    declared = F.col("_entry.value")
    stored = F.upper(declared)
    for name, target in STORED_TYPES.items():
        stored = F.when(declared == name, F.lit(target)).otherwise(stored)
    return parsed.select(
        *kept, "_key", F.posexplode(F.map_entries("_columns")).alias("_pos", "_entry")
    ).select(
        *kept, (F.col("_pos") + 1).alias("position"),
        F.col("_entry.key").alias("column_name"), declared.alias("declared_type"),
        stored.alias("stored_type"),
        F.coalesce(F.array_contains("_key", F.col("_entry.key")), F.lit(False)).alias("is_key"),
    )
