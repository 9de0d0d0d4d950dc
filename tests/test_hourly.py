import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import types as T
from helpers import NOW, at, fold, hour_tuples, item_types, limits, reading, readings

from gridtally.operators import clean, hourly
from gridtally.schemas import READING_SCHEMA

# The sample records of one meter between 12:00 and 14:00, in the order they were sent.
GOLDEN = [
    ("48890.80", "20171009130000"), ("48894.40", "20171009133000"),
    ("48898.20", "20171009140000"), ("48883.40", "20171009120000"),
    ("48887.20", "20171009123000"), ("48892.60", "20171009131500"),
    ("48896.20", "20171009134500"), ("48885.20", "20171009121500"),
]


def cleaned(spark, rows):
    return clean.clean_readings(readings(spark, rows), item_types(spark), NOW)


def hours(spark, rows, item_limits=()):
    return hour_tuples(hourly.hourly_consumption(cleaned(spark, rows), limits(spark, item_limits)))


def test_golden_meter(spark):
    rows = [
        ("430100A001", "01", "10", "02-1", "01  ", None, "0", v, "null", t) for v, t in GOLDEN
    ]
    name = "430100A001_01_10"
    assert hours(spark, rows) == [
        (name, 12, datetime(2017, 10, 9, 12), 7.4, 48890.8, 0),
        (name, 12, datetime(2017, 10, 9, 13), 7.4, 48898.2, 0),
    ]
    state = hourly.current_info(cleaned(spark, rows), limits(spark)).first()
    assert (state.date_time, float(state.real_value), state.status) == (
        datetime(2017, 10, 9, 14), 48898.2, "0"
    )


def test_golden_quarantine(spark):
    # The sample records that are no readings.
    bad = [("48892.60", "20171009131B00"), ("48892.60", "null"),
           ("48,892.60", "20171009124500"), (None, "20171009125000")]
    rows = [("430100A001", "01", "10", "01-1", "01  ", None, "0", v, "null", t) for v, t in bad]
    good, rejected = clean.quarantine_split(readings(spark, rows), NOW)
    assert good.count() == 0 and rejected.count() == 4
    assert rejected.schema == READING_SCHEMA


def test_edges(spark):
    rows = [
        reading("gap", at(0), "1"), reading("gap", at(2), "5"), reading("gap", at(3), "6"),
        reading("down", at(0), "9"), reading("down", at(1), "4"),
        reading("top", at(0), "0"), reading("top", at(1), "100"),
        reading("near", at(0), "0"), reading("near", at(1), "99.99"),
        reading("same", at(0), "1"), reading("same", at(0, 30), "7"),
    ]
    got = hours(spark, rows, [("B0_G0_top", 11, "100", "1"), ("B0_G0_near", 11, "100", "1")])
    assert [(n[6:], h, v, e) for n, _, h, v, _, e in got] == [
        ("down", at(0), 0.0, 2), ("gap", at(2), 1.0, 0), ("near", at(0), 99.99, 0),
        ("top", at(0), 100.0, 2),
    ]


def test_cleaning(spark):
    ok = reading("m", at(1), "1")
    rows = [
        ok, reading("m", at(1), "1", status=" 0 "), reading("m", at(1), "1", status="1"),
        reading("m", at(1), "1", status=None), reading("m", at(1), "1", param="99-9"),
        reading("m", at(1), "NaN"), reading("m", None, "1"), reading(None, at(1), "1"),
        reading("m", at(1), "1", building=None), reading("m", at(24 * 400), "1"),
        reading("m", "2024030101", "1"),
    ]
    got = cleaned(spark, rows)
    assert got.count() == 3
    assert {r.hour for r in got.collect()} == {at(1)}


def test_coefficient_applies_to_value_and_register(spark):
    rows = [reading("m", at(0), "10"), reading("m", at(1), "13")]
    assert hours(spark, rows, [("B0_G0_m", 11, "100", "2.5")]) == [
        ("B0_G0_m", 11, at(0), 7.5, 32.5, 0)
    ]


def test_position_decides_between_equal_times(spark):
    rows = [(*reading("m", at(0), v), p) for v, p in [("5", 2), ("3", 1), ("9", 3)]]
    rows.append((*reading("m", at(1), "10"), 4))
    df = spark.createDataFrame(rows, T.StructType([*READING_SCHEMA.fields, T.StructField("pos_", T.LongType())]))
    got = clean.clean_readings(df, item_types(spark), NOW, position="pos_")
    assert hour_tuples(hourly.hourly_consumption(got, limits(spark)))[0][3] == 7.0


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_a_hot_meter(spark, seed):
    """One meter holds a third of all readings; every form gives the fold's rows."""
    random.seed(seed)
    series = defaultdict(list)
    for i in range(3000):
        meter = "hot" if random.random() < 0.34 else f"m{random.randrange(12)}"
        when = at(random.randrange(60), random.randrange(60))
        series[meter].append((when.replace(second=random.randrange(60)), i))
    rows, want, last = [], [], {}
    for meter, points in series.items():
        unique = {t: random.randrange(0, 300) for t, _ in points}
        rows += [reading(meter, t, str(v)) for t, v in unique.items()]
        out, last[meter] = fold([(t, float(v)) for t, v in unique.items()], limit=150.0)
        want += [(f"B0_G0_{meter}", 11, h, v, r, e) for h, v, r, e in out]
    random.shuffle(rows)
    tops = limits(spark, [(f"B0_G0_{m}", 11, "150", "1") for m in series])
    data = cleaned(spark, rows).persist()
    assert hour_tuples(hourly.hourly_consumption(data, tops)) == sorted(want)
    assert hour_tuples(hourly.hourly_selfjoin(data, tops)) == sorted(want)
    state = {r.item_name[6:]: (r.date_time, float(r.real_value))
             for r in hourly.current_info(data, tops).collect()}
    assert state == last
    data.unpersist()


@pytest.mark.parametrize("cut", [at(10, 20), at(20), at(33, 59)])
def test_state_continues_where_a_batch_ended(spark, cut):
    random.seed(7)
    times_ = sorted({at(random.randrange(40), random.randrange(60)) for _ in range(300)})
    rows = [reading(f"m{i % 3}", t, str(i * 3)) for i, t in enumerate(times_)]
    early = [r for r in rows if r[9] < cut.strftime("%Y%m%d%H%M%S")]
    none = limits(spark)
    before = cleaned(spark, early)
    state = hourly.current_info(before, none)
    late_and_new = cleaned(spark, rows)  # repeats what the state has seen
    first = hour_tuples(hourly.hourly_consumption(before, none))
    second = hour_tuples(hourly.hourly_with_state(late_and_new, none, state))
    assert sorted(first + second) == hours(spark, rows)
    whole = hourly.current_info(late_and_new, none, state).collect()
    assert sorted(whole) == sorted(hourly.current_info(late_and_new, none).collect())


def test_state_wins_over_a_reading_of_its_hour(spark):
    none = limits(spark)
    state = hourly.current_info(cleaned(spark, [reading("m", at(5, 30), "50")]), none)
    batch = cleaned(spark, [reading("m", at(5, 10), "1"), reading("m", at(6), "60")])
    assert hour_tuples(hourly.hourly_with_state(batch, none, state)) == [
        ("B0_G0_m", 11, at(5), 10.0, 60.0, 0)
    ]
    same_hour = cleaned(spark, [reading("m", at(5, 10), "1")])
    assert float(hourly.current_info(same_hour, none, state).first().real_value) == 50.0


def test_gap_class(spark):
    rows = [reading("m", t, "1") for t in (at(0), at(0, 5), at(1), at(4))]
    got = hourly.gap_class(cleaned(spark, rows)).orderBy("hour").collect()
    assert [(r.gap_class, r.gap_hours, r.n_ignored) for r in got] == [
        ("first", None, 1), ("consecutive", 1, 0), ("gap", 3, 0)
    ]
