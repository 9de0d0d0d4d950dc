"""Keys, codes and small JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item_name(building: Column, gate: Column, meter: Column) -> Column:
    """``building_gate_meter``; null when a part is null."""
    return F.concat(building, F.lit("_"), gate, F.lit("_"), meter)


def collector_code(building: Column, gateway: Column) -> Column:
    return F.concat(building, F.lit("_"), gateway)


def building_of(name: Column) -> Column:
    return F.element_at(F.split(name, "_"), 1)


def collector_of(name: Column) -> Column:
    return F.try_element_at(F.split(name, "_"), F.lit(2))


def is_electric(basic_code: Column) -> Column:
    """Spaces around one ``A``; a missing code counts as another medium."""
    return F.coalesce(basic_code.rlike("^ *A *$"), F.lit(False))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def subentry_prefix(code: Column) -> Column:
    return F.substring(F.trim(code), 1, 3)


def parse_json_array(text: Column) -> Column:
    """Elements of a flat JSON array as text; null when the record is malformed."""
    return F.from_json(text, "array<string>")


def parse_json_object(text: Column) -> Column:
    """A flat JSON object as an ordered list of (key, value) pairs."""
    return F.map_entries(F.from_json(text, "map<string,string>"))


def sort_points(points: Column) -> Column:
    """Array of structs in order of the number after the two-letter prefix of ``pointName``.

    Elements with the same number keep their order.
    """
    keyed = F.transform(
        points,
        lambda p, i: F.struct(
            F.substring(p["pointName"], 3, 2147483647).cast("decimal(38,0)").alias("n"), i.alias("i")
        ),
    )
    return F.transform(F.array_sort(keyed), lambda k: F.get(points, k["i"]))
