"""Interval subtraction against hours counted one by one."""

import random

from helpers import at

from gridtally.operators import intervals


def ranges(spark, rows):
    return spark.createDataFrame([(k, at(a), at(b)) for k, a, b in rows],
                                 "k string, start timestamp, end timestamp")


def hours_of(rows):
    """Hours covered, by key."""
    return {(k, h) for k, a, b in rows for h in range(a, b)}


def back(df):
    return [(r.k, int((r.start - at(0)).total_seconds() // 3600), int((r.end - at(0)).total_seconds() // 3600))
            for r in df.collect()]


def test_subtract_is_hour_by_hour(spark):
    rng = random.Random(3)

    def some(n):
        return [(rng.choice("ab"), a := rng.randrange(60), a + rng.randrange(0, 12)) for _ in range(n)]

    for wanted, covered in [(some(4), some(n)) for n in (0, 1, 5, 9)] + [([("a", 0, 50)], some(12))]:
        got = back(intervals.subtract(ranges(spark, wanted), ranges(spark, covered), ["k"]))
        assert hours_of(got) == hours_of(wanted) - hours_of(covered)
        ends = sorted(got)
        assert all(x[0] != y[0] or x[2] < y[1] for x, y in zip(ends, ends[1:], strict=False))
        made = back(intervals.islands(ranges(spark, covered), ["k"]))
        assert hours_of(made) == hours_of(covered) and len(made) <= len(covered)


def test_empty_and_null_ranges_cover_nothing(spark):
    rows = spark.createDataFrame([("a", at(3), at(3)), ("a", None, at(9)), ("a", at(5), at(4)), ("a", at(1), None)],
                                 "k string, start timestamp, end timestamp")
    assert back(intervals.subtract(ranges(spark, [("a", 0, 9)]), rows, ["k"])) == [("a", 0, 9)]
    assert intervals.subtract(rows, ranges(spark, []), ["k"]).collect() == []
    whole = intervals.islands(ranges(spark, [("a", 0, 3), ("b", 3, 4), ("b", 9, 10)]).drop("k"))
    assert sorted((r.start, r.end) for r in whole.collect()) == [(at(0), at(4)), (at(9), at(10))]
