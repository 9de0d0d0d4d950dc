from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridtally.functions import formula, numbers, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw, want", [
    ("2017100912", datetime(2017, 10, 9, 12)),
    ("20171009123001", datetime(2017, 10, 9, 12, 30, 1)),
    (" 20171009123001 ", datetime(2017, 10, 9, 12, 30, 1)),
    ("2017-10-09 12:30:01", datetime(2017, 10, 9, 12, 30, 1)),
    ("20171009131B00", None),
    ("20171399250000", None),
    ("null", None), ("", None), (None, None),
])
def test_parse_time(spark, raw, want):
    assert one(spark, times.parse_time(F.lit(raw).cast("string"))) == want


def test_future_times(spark):
    at = F.lit("20240301120000")
    assert one(spark, times.is_valid_time(at, "2024-03-01 12:00:00"))
    assert not one(spark, times.is_valid_time(at, "2024-03-01 11:59:59"))
    assert one(spark, times.is_valid_time(at, "2024-03-01 11:00:00", 3600))
    assert not one(spark, times.is_valid_time(at, "2024-03-01 10:59:59", 3600))


def test_time_range():
    assert times.is_valid_range("20190730120000", "20190731140000")
    assert not times.is_valid_range("20190731140000", "20190730120000")
    assert not times.is_valid_range("2019", "20190730120000")
    assert times.is_valid_range("2019-07-30 12:00:00", "20190731140000")
    assert not times.is_valid_range("2024-12-01 00:00:00", "20240101000000")


def test_mixed_formats_sort(spark):
    rows = [("2019-07-14 11:00:00",), ("20190716110000",), ("20190616110000",)]
    df = spark.createDataFrame(rows, "t string").orderBy(times.parse_time(F.col("t")))
    assert [r.t for r in df.collect()] == [
        "20190616110000", "2019-07-14 11:00:00", "20190716110000"
    ]


def test_anchors(spark):
    anchors = times.calendar_anchors(times.parse_time(F.lit("20190717000000")))
    row = spark.range(1).select(*[c.alias(n) for n, c in anchors.items()]).first()
    assert len(anchors) == 11
    assert row.current_month == datetime(2019, 7, 1)
    assert row.next_month == datetime(2019, 8, 1)
    assert row.last_two_hour == datetime(2019, 7, 16, 22)
    assert row.next_day == datetime(2019, 7, 18)


def test_months_clip(spark):
    jan31 = F.lit("2024-01-31 10:00:00").cast("timestamp")
    assert one(spark, times.add_months(jan31, 1)) == datetime(2024, 2, 29, 10)
    assert one(spark, times.add_years(jan31, 1)) == datetime(2025, 1, 31, 10)


def test_exact_arithmetic(spark):
    assert one(spark, numbers.exact_difference(F.lit(2723.83), F.lit(2723.87))) == Decimal("0.04")
    assert one(spark, numbers.exact_sum(F.lit(0.06), F.lit(0.02))) == Decimal("0.08")
    assert one(spark, numbers.exact_product(F.lit("1.1"), F.lit("3"))) == Decimal("3.3")


@pytest.mark.parametrize("raw, want", [
    ("48892.60", True), (" 12 ", True), ("1e3", True), ("-5", True),
    ("48,892.60", False), ("NaN", False), ("1d", False), ("", False), (None, False),
])
def test_numbers(spark, raw, want):
    assert one(spark, numbers.is_valid_number(F.lit(raw).cast("string"))) is want


@pytest.mark.parametrize("code, want", [
    ("   A ", True), ("A", True), (".A", False), ("AA", False), ("cAc", False), (None, False),
])
def test_medium(spark, code, want):
    assert one(spark, text.is_electric(F.lit(code).cast("string"))) is want


def test_keys(spark):
    name = F.lit("B1_G2_M3")
    assert one(spark, text.building_of(name)) == "B1"
    assert one(spark, text.collector_of(name)) == "G2"
    assert one(spark, text.collector_of(F.lit("B1"))) is None
    assert one(spark, text.item_name(F.lit("B"), F.lit(None).cast("string"), F.lit("M"))) is None
    assert [tuple(e) for e in one(spark, text.parse_json_object(F.lit('{"b":1,"a":2}')))] == [
        ("b", "1"), ("a", "2")
    ]


def test_sort_points_is_stable(spark):
    rows = [([("dp10", "x"), ("dp2", "y"), ("xx2", "z"), ("dp1", "w")],)]
    df = spark.createDataFrame(rows, "p array<struct<pointName:string,tag:string>>")
    got = df.select(text.sort_points(F.col("p")).alias("p")).first().p
    assert [e.tag for e in got] == ["w", "y", "z", "x"]


@pytest.mark.parametrize("source, inputs, want", [
    ("d1 + ( d2 + d3 - d4 * ( d5 / d6 ) )", {}, 1 + (2 + 3 - 4 * 5 / 6)),
    ("1000 + 1004 - d5 * ( d2 )", {1000: 30.5, 1004: 2.0}, 22.5),
    ("1000 # 1004", {1000: 1.0, 1004: 3.5}, -2.5),
    ("d8 / d2 / d2", {}, 2.0),
    ("d2 + d3 * d4", {}, 14.0),
    ("( d2 + d3 ) * d4", {}, 20.0),
    ("d1 d2 + d1", {}, 13.0),
    ("7", {}, 0.0),
    ("7 * d3", {7: -2.0}, -6.0),
    ("d5 / d0", {}, 0.0),
    ("d1 + d5 / ( d1 - d1 )", {}, 0.0),
    ("( d1 + d2", {}, 0.0),
    ("d1 + d2 )", {}, 0.0),
    ("d1 + x", {}, 0.0),
    ("- d1", {}, 0.0),
    ("d1 +", {}, 0.0),
    ("", {}, 0.0),
    (None, {}, 0.0),
])
def test_formula(spark, source, inputs, want):
    df = spark.createDataFrame([(source, inputs)], "f string, m map<bigint,double>")
    compiled = df.select(formula.compile_formula("f").alias("p"), "m")
    got = compiled.select(formula.evaluate(F.col("p"), F.col("m")).alias("x")).first().x
    assert got == pytest.approx(want)


def test_formula_references(spark):
    df = spark.createDataFrame([("12 + 7 * 12 - d3",)], "f string")
    refs = df.select(formula.compile_formula("f").alias("p"))
    got = refs.select(formula.referenced_items(F.col("p")).alias("r")).first().r
    assert sorted(got) == [7, 12]


def test_odd_formulas(spark):
    long_id = "1" * 25
    for text in ["dnan", "dinf", "d1_000", "d0x1"]:
        assert formula.to_postfix(text) is None
    assert formula.to_postfix("d1e3") == ["1000.0"]
    ids = F.array(*[F.lit(s) for s in ("@" + long_id, "@7", "@7")])
    assert one(spark, formula.referenced_items(ids)) == [7]
    inputs = F.create_map(F.lit(7).cast("long"), F.lit(2.0))
    symbols = F.array(F.lit("@" + long_id), F.lit("@7"), F.lit("+"))
    assert one(spark, formula.evaluate(symbols, inputs)) == 2.0


def test_sort_points_beyond_32_bits(spark):
    points = F.array(*[F.struct(F.lit(n).alias("pointName")) for n in ("dp3000000000", "dp2", "dp10")])
    got = one(spark, text.sort_points(points))
    assert [p.pointName for p in got] == ["dp2", "dp10", "dp3000000000"]


def test_exact_product_never_rounds_its_inputs(spark):
    product = numbers.exact_product(F.lit("1.000001"), F.lit("3"))
    assert float(one(spark, product)) == 3.000003
    with pytest.raises(Exception, match="more than six decimals"):
        one(spark, numbers.exact_product(F.lit("0.0000004"), F.lit("3")))


def test_rounding_modes(spark):
    import decimal

    texts = ["0", "1.005", "-1.005", "1.0049999999", "1.015", "-2.5", "2.5", "3.5", "-0.001", "0.009", "1.23",
             "123456789012345678.125", "-99.995"]
    python = {m: getattr(decimal, f"ROUND_{m.upper()}") for m in numbers.ROUNDING if m != "unnecessary"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for places in (0, 2, 10):
        made = df.select("t", *[numbers.rounded(F.col("t"), places, m).alias(m) for m in python]).collect()
        for r in made:
            with decimal.localcontext(decimal.Context(prec=60)):
                for m, mode in python.items():
                    assert r[m] == decimal.Decimal(r.t).quantize(decimal.Decimal(1).scaleb(-places), mode), (r.t, m)
    assert float(one(spark, numbers.rounded(F.lit(2.675), 2, "half_even"))) == 2.68  # as the double prints
    assert float(one(spark, numbers.rounded(F.lit("1.25"), 2, "unnecessary"))) == 1.25
    assert one(spark, numbers.rounded(F.lit(1e40), 2)) is None
    with pytest.raises(Exception, match="needs rounding"):
        one(spark, numbers.rounded(F.lit("1.255"), 2, "unnecessary"))
    for places, mode in [(2, "half"), (11, "up")]:
        with pytest.raises(ValueError):
            numbers.rounded(F.lit(1.0), places, mode)


@pytest.mark.parametrize("mode, want", [("half_up", 0.13), ("half_down", 0.12), ("up", 0.13), ("half_even", 0.12)])
def test_formula_in_a_rounding_mode(spark, mode, want):
    df = spark.createDataFrame([("7 / d8", {7: 1.0})], "f string, m map<bigint,double>")
    compiled = df.select(formula.compile_formula("f").alias("p"), "m")
    got = compiled.select(formula.result(F.col("p"), F.col("m"), 2, mode).alias("x")).first().x
    assert float(got) == want
