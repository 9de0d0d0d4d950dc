"""Dimensions, rollups, sub-entries, queue and virtual meters on small literals."""

from decimal import Decimal

import pytest
from helpers import BASE, at, hour_tuples
from pyspark.sql import functions as F

from gridtally.operators import dims, queue, rollup, subentry, virtual
from gridtally.schemas import HOUR_SCHEMA, QUEUE_SCHEMA


def hour_rows(spark, rows):
    """Rows of (meter, hour, value[, error[, type id, type[, place]]])."""
    full = []
    for row in rows:
        meter, hour, value, *more = row
        error, type_id, kind, place = (*more, *[0, 11, "A", "B0_G0"][len(more):])
        full.append((f"{place}_{meter}", type_id, at(hour), Decimal(value), Decimal(value) * 10,
                     Decimal(0), error, kind))
    return spark.createDataFrame(full, HOUR_SCHEMA)


def dimensions(spark):
    frame = spark.createDataFrame
    return dims.Dimensions(
        frame([(1, "B0"), (2, "B1")], "id int, code string"),
        frame([(1, "G0", 1), (2, "G1", 2)], "id int, code string, building_id int"),
        frame(
            [(1, "m1", 1, 11, None, None, 1), (2, "m2", 1, 11, -1.0, -2.0, 2),
             (3, "m3", 2, 11, 50.0, 0.0, 6), (4, "w", 1, 12, 0.0, 3.0, 1),
             (10, "V", 1, 11, 30.0, None, 3), (11, "W", 1, 12, None, None, None),
             (12, "N", 1, 11, None, None, None)],
            "id int, code string, collector_id int, data_type int, max_value double,"
            " coefficient double, subentry int",
        ),
        frame([(11, "01-1", "A", "e"), (12, "02-1", "B", "o")],
              "id int, code string, basic_code string, table_name string"),
        frame([(10, "1 + 2"), (11, "4 + 1"), (12, "99 + d1")], "item_id int, formula string"),
        frame([(1, "0101"), (2, " 01A1"), (3, "01B2"), (6, "01E1")], "id int, code string"),
    )


def test_item_limits(spark):
    got = {r.item_name: (float(r.max_value), float(r.coefficient))
           for r in dimensions(spark).limits.collect()}
    assert got["B0_G0_m1"] == (10000, 1) and got["B0_G0_m2"] == (10000, 1)
    assert got["B1_G1_m3"] == (50, 0) and got["B0_G0_w"] == (0, 3)
    d = dimensions(spark)
    one = dims.item_limits(d.building, d.collector, d.item, "B1", "G1", "m3")
    assert [r.item_name for r in one.collect()] == ["B1_G1_m3"]


def test_other_lookups(spark):
    d = dimensions(spark)
    assert {r.item_name for r in d.subentries.collect()} == {
        "B0_G0_m1", "B0_G0_m2", "B1_G1_m3", "B0_G0_V"
    }
    assert {(r.item_name, r.type_code) for r in d.virtuals.collect()} == {
        ("B0_G0_V", "01-1"), ("B0_G0_W", "02-1"), ("B0_G0_N", "01-1")
    }
    assert d.codes.where("item_id = 3").first().item_name == "B1_G1_m3"


def test_rollups(spark):
    rows = hour_rows(spark, [
        ("m", 1, "2"), ("m", 23, "3"), ("m", 5, "100", 2), ("m", 24, "7"), ("n", 0, "1", 2),
    ])
    day = rollup.day_rollup(rows)
    assert hour_tuples(day) == [
        ("B0_G0_m", 11, at(0), 5.0, 30.0, 0), ("B0_G0_m", 11, at(24), 7.0, 70.0, 0)
    ]
    assert hour_tuples(rollup.month_rollup(day)) == [("B0_G0_m", 11, BASE, 12.0, 70.0, 0)]


@pytest.mark.parametrize("cut", [1, 12, 24, 100])
def test_adding_hours_equals_recomputing(spark, cut):
    rows = hour_rows(spark, [("m", h, str(h)) for h in range(0, 60, 3)])
    split = F.col("date_time") < F.lit(at(cut))
    stored = rollup.day_rollup(rows.where(split))
    added = rollup.add_to_rollup(stored, rows.where(~split), "day")
    assert sorted(added.collect()) == sorted(rollup.day_rollup(rows).collect())


def test_subentries(spark):
    rows = hour_rows(spark, [
        ("m1", 1, "2"), ("m2", 1, "3"), ("V", 1, "4"), ("m1", 1, "9", 2, 12, "B"),
        ("m2", 2, "8", 2), ("x", 1, "100"), ("m3", 1, "6", 0, 11, "A", "B1_G1"),
    ])
    got = subentry.subentry_hour(rows, dimensions(spark).subentries)
    by = {r.building_code: r for r in got.collect()}
    assert [float(x) for x in by["B0"][1:7]] == [2, 3, 4, 0, 0, 0]
    assert [float(x) for x in by["B1"][1:7]] == [0, 0, 0, 0, 0, 0]  # its code fits no bucket
    day = subentry.subentry_day(got).where("building_code = 'B0'").first()
    assert (day.data_time, float(day.electricity_b)) == (at(0), 4.0)


def test_third_party(spark):
    rows = hour_rows(spark, [
        ("m1", 1, "2"), ("m2", 1, "3", 2), ("V", 1, "100000"), ("m1", 2, "9"),
        ("m3", 1, "6", 0, 11, "A", "B1_G1"), ("q", 3, "5"), ("m1", 1, "70", 0, 11, "A", "B0_G01"),
    ])
    asked = [("B0", "G0", "2024030101", 2), ("B0", "G0", "2024030103", 2),
             ("B1", "G1", "2024030101", 2), ("B1", "G1", "2024030101", 3),
             ("B0", "G0", "2024030102", 0)]
    pending = queue.pending_third_party(spark.createDataFrame(asked, QUEUE_SCHEMA), "2024030200")
    added = subentry.third_party_amounts(pending, rows, dimensions(spark).subentries)
    got = {(r.building_code, r.data_time): [float(x) for x in r[1:6]] for r in added.collect()}
    # Invalid rows count, the ceiling does not, an unmapped item makes a row of zeros.
    assert got == {("B0", at(1)): [2, 3, 0, 0, 0], ("B0", at(3)): [0, 0, 0, 0, 0]}
    stored = subentry.subentry_hour(rows, dimensions(spark).subentries)
    total = subentry.add_buckets(stored, added)
    one = total.where(F.col("data_time") == F.lit(at(1))).where("building_code = 'B0'").first()
    assert float(one.electricity) == 4.0
    assert total.count() == stored.select("building_code", "data_time").union(
        added.select("building_code", "data_time")).distinct().count()


def test_queue(spark):
    rows = [("B", "G", "2024030101", 0), ("B", "G", "2024030101", 0), ("B", "H", "2024030105", 0),
            ("B", "G", "2024030101", 2), ("B", "G", "2024030103", 2), ("B", "G", "2024030103", 3)]
    q = spark.createDataFrame(rows, QUEUE_SCHEMA)
    assert [tuple(r) for r in queue.pending(q, "2024-03-01 04:30:00").collect()] == [
        ("B", "G", "2024030101")
    ]
    assert queue.pending_third_party(q, "20240301030000").count() == 1
    marked = queue.mark(q, "2024030102", queue.THIRD_PARTY, queue.DONE)
    assert sorted(r.type for r in marked.collect()) == [0, 0, 0, 2, 3, 3]
    assert queue.purge(q, "2024030103", queue.OWN).count() == 4
    assert queue.purge(q, "2024030103", queue.THIRD_PARTY, at=True).count() == 5


def queued(spark, *hours, place=("B0", "G0")):
    rows = [(*place, f"2024030{1 + h // 24}{h % 24:02d}", 0) for h in hours]
    return spark.createDataFrame(rows, QUEUE_SCHEMA)


def run_virtual(spark, rows, due):
    d = dimensions(spark)
    return hour_tuples(virtual.virtual_hour(hour_rows(spark, rows), d.virtuals, d.codes, due))


def test_virtual_rows(spark):
    rows = [
        ("m1", 1, "10"), ("m2", 1, "20"),           # 30: the limit itself is valid
        ("m1", 2, "10"), ("m2", 2, "20.01"),        # above it
        ("m1", 3, "10"), ("m2", 3, "5", 2),         # an invalid input counts as 0
        ("m1", 4, "10", 2),                         # no valid input: no row
        ("m1", 5, "1"),                             # not queued: no row
        ("w", 6, "4", 0, 12, "B"), ("m1", 6, "9"),  # W reads only its own side
    ]
    got = run_virtual(spark, rows, queued(spark, 2, 3, 4, 5, 7))
    assert [(n[6:], h, v, e) for n, _, h, v, _, e in got] == [
        ("V", at(1), 30.0, 0), ("V", at(2), 30.01, 2), ("V", at(3), 10.0, 0),
        ("V", at(6), 9.0, 0), ("W", at(6), 4.0, 0),
    ]
    assert run_virtual(spark, rows, queued(spark, 2, 3, place=("B1", "G1"))) == []


def test_virtual_result_is_rounded_and_not_negative(spark):
    d = dimensions(spark)
    formulas = spark.createDataFrame(
        [(10, "1 / d3"), (12, "1 - d20")], "item_id int, formula string"
    )
    virtuals = dims.virtual_items(d.building, d.collector, d.item, formulas, d.item_type)
    rows = hour_rows(spark, [("m1", 1, "10")])
    got = hour_tuples(virtual.virtual_hour(rows, virtuals, d.codes, queued(spark, 2)))
    assert got == [
        ("B0_G0_N", 11, at(1), 0.0, 80.0, 2), ("B0_G0_V", 11, at(1), 3.33, 33.33, 0)
    ]


def test_virtual_changes(spark):
    old = hour_rows(spark, [("V", 1, "5"), ("V", 2, "7")])
    new = hour_rows(spark, [("V", 1, "8"), ("V", 2, "7"), ("V", 3, "1")])
    got = {r.date_time: (r.is_new, float(r.change_value)) for r in virtual.changes(new, old).collect()}
    assert got == {at(1): (False, 3.0), at(3): (True, 1.0)}


def formula_dimensions(spark, formulas):
    """Dimensions of one collector with a meter 1, and virtual items by id and formula."""
    d = dimensions(spark)
    frame = spark.createDataFrame
    return dims.Dimensions(
        d.building, d.collector,
        frame([(1, "m1", 1, 11, None, None, None),
               *[(i, f"v{i}", 1, 11, None, None, None) for i in formulas]],
              "id int, code string, collector_id int, data_type int, max_value double,"
              " coefficient double, subentry int"),
        d.item_type, frame(list(formulas.items()), "item_id int, formula string"), d.subentry,
    )


def own_hours(spark, hours):
    return spark.createDataFrame(
        [("B0", "G0", at(h + 1).strftime("%Y%m%d%H"), 0) for h in hours], QUEUE_SCHEMA)


def by_recursion(formulas, meter):
    """Values of sums over ids and constants by plain recursion; None for members of cycles."""
    parts = {i: [p for p in f.split() if p != "+"] for i, f in formulas.items()}
    refs = {i: {int(p) for p in ps if p.isdigit()} & set(formulas) for i, ps in parts.items()}

    def reaches(a, b, seen=()):
        return any(r == b or (r not in seen and reaches(r, b, (*seen, r))) for r in refs[a])

    cyclic = {i for i in formulas if reaches(i, i)}

    def value(i):
        if i in cyclic or i not in formulas:
            return meter if i == 1 else None
        found = [value(int(p)) for p in parts[i] if p.isdigit()]
        if all(v is None for v in found):
            return None
        return sum(v or 0 for v in found) + sum(float(p[1:]) for p in parts[i] if not p.isdigit())

    return {i: value(i) for i in formulas}


@pytest.mark.parametrize("formulas", [
    {10: "1 + d1", 11: "10 + 1", 12: "11 + 10", 13: "12 + d2"},
    {10: "11 + 1", 11: "10 + 1", 12: "10 + 1", 13: "12 + 11", 14: "14 + 1", 15: "14 + 10"},
    {10: "11", 11: "12 + 1", 12: "10", 13: "10 + 20", 20: "21 + 1", 21: "20 + 13 + 1", 30: "20 + 1"},
    {10: "99 + d5", 11: "10 + 1", 12: "10"},
])
def test_nested_formulas(spark, formulas):
    d = formula_dimensions(spark, formulas)
    hours = hour_rows(spark, [("m1", 0, "7"), ("m1", 1, "9", 2), ("m1", 2, "3")])
    got = {(r.item_name, r.date_time): float(r.value) for r in virtual.virtual_hour(
        hours, d.virtuals, d.codes, own_hours(spark, range(3))).collect()}
    want = {}
    for hour, meter in ((0, 7.0), (2, 3.0)):
        for i, v in by_recursion(formulas, meter).items():
            if v is not None:
                want[f"B0_G0_v{i}", at(hour)] = v
    assert got == want


def test_only_cycles_give_nothing(spark):
    d = formula_dimensions(spark, {10: "11 + 1", 11: "10"})
    hours = hour_rows(spark, [("m1", 0, "7")])
    assert virtual.virtual_hour(hours, d.virtuals, d.codes, own_hours(spark, [0])).collect() == []


def test_an_invalid_nested_row_is_a_missing_input(spark):
    d = formula_dimensions(spark, {10: "d1 - 1", 11: "10 + 1", 12: "10"})
    hours = hour_rows(spark, [("m1", 0, "7")])
    got = {r.item_name: (float(r.value), r.error) for r in virtual.virtual_hour(
        hours, d.virtuals, d.codes, own_hours(spark, [0])).collect()}
    assert got == {"B0_G0_v10": (0.0, 2), "B0_G0_v11": (7.0, 0)}


def test_propagation_is_a_full_recompute_of_few_rows(spark):
    import random

    formulas = {10: "1 + d1", 11: "10 + 2", 12: "11 + 10", 13: "3 + 2", 14: "15 + 1", 15: "14", 16: "15 + 13"}
    d = formula_dimensions(spark, formulas)
    items = d.item.unionByName(spark.createDataFrame(
        [(2, "m2", 1, 11, None, None, None), (3, "m3", 1, 11, None, None, None)], d.item.schema))
    d = dims.Dimensions(d.building, d.collector, items, d.item_type, d.item_virtual, d.subentry)
    rng = random.Random(4)
    before = {(m, h): str(rng.randrange(1, 50)) for m in ("m1", "m2", "m3") for h in range(12)}
    after = dict(before)
    after["m1", 3] = "77"      # moves: 10, 11 and 12 follow
    del after["m3", 5]         # goes: 13 and, by way of it, 16
    after["m2", 11] = "5"

    def rows(values):
        return hour_rows(spark, [(m, h, v) for (m, h), v in values.items()])

    def full(values, hours):
        return virtual.virtual_hour(rows(values), d.virtuals, d.codes, own_hours(spark, hours))

    changed = spark.createDataFrame(
        [(f"B0_G0_{m}", 11, at(h)) for m, h in (("m1", 3), ("m3", 5), ("m2", 11))],
        "item_name string, type_id int, date_time timestamp")
    old = full(before, range(11))  # hour 11 is due only now
    got = virtual.propagate(old, changed, rows(after), d.virtuals, d.codes,
                            own_hours(spark, range(12)), own_hours(spark, [11]))
    want = {(r.item_name, r.date_time): r.value for r in full(after, range(12)).collect()}
    assert {(r.item_name, r.date_time): r.value for r in got.rows.collect()} == want
    dirty = {(r.item_name[-3:], r.date_time) for r in got.dirty.collect()}
    assert dirty == ({(f"v{i}", at(3)) for i in (10, 11, 12)} | {(f"v{i}", at(5)) for i in (13, 16)}
                     | {(f"v{i}", at(11)) for i in (10, 11, 12, 13, 16)})
    assert got.computed.count() <= len(dirty)
    none = virtual.propagate(old, changed.limit(0), rows(before), d.virtuals, d.codes,
                             own_hours(spark, range(11)), own_hours(spark, []))
    assert none.dirty.count() == 0 and sorted(none.rows.collect()) == sorted(old.collect())


def test_formulas_are_put_in_order_once(spark, monkeypatch):
    d = formula_dimensions(spark, {10: "1 + d1", 11: "10 + 1", 12: "12", 13: "12 + 11"})
    rows = hour_rows(spark, [("m1", h, str(h + 1)) for h in range(4)])
    queue = own_hours(spark, range(4))
    want = virtual.virtual_hour(rows, d.virtuals, d.codes, queue)
    made = virtual.formulas(d.virtuals, d.codes)
    monkeypatch.setattr(virtual.formula_graph, "levels", None)
    before = virtual.virtual_hour(
        rows.where(F.hour("date_time") < 2), d.virtuals, d.codes, queue, formulas=made)
    after = virtual.propagate(
        before, rows.where(F.hour("date_time") >= 2), rows, d.virtuals, d.codes, queue,
        queue.limit(0), formulas=made)
    assert want.count() > before.count() > 0
    assert sorted(after.rows.collect()) == sorted(want.collect())
