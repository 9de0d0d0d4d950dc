import pytest
from pyspark.sql import functions as F

from gridtally.operators import casting, merge
from gridtally.sources import tables


def kv(spark, rows, kind="string"):
    return spark.createDataFrame(rows, f"k int, v {kind}")


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upserts(spark):
    target = kv(spark, [(1, "a"), (2, "b")])
    source = kv(spark, [(2, "B"), (3, "C")])
    assert pairs(merge.upsert_replace(target, source, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert pairs(merge.insert_if_absent(target, source, ["k"])) == [(1, "a"), (2, "b"), (3, "C")]
    twice = merge.upsert_replace(merge.upsert_replace(target, source, ["k"]), source, ["k"])
    assert pairs(twice) == [(1, "a"), (2, "B"), (3, "C")]


def test_last_per_key(spark):
    batch = spark.createDataFrame([(1, "x", 1), (1, None, 3), (1, "y", 2), (2, "z", 0)],
                                  "k int, v string, n int")
    assert pairs(merge.last_per_key(batch, ["k"], ["n"])) == [(1, None, 3), (2, "z", 0)]


def test_add(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k int, n long, last string")
    target = frame([(1, 5, "old"), (2, 1, "keep")])
    got = merge.upsert_add(target, frame([(1, 7, "new"), (3, 4, "new")]), ["k"], ["n"], ["last"])
    assert pairs(got) == [(1, 12, "new"), (2, 1, "keep"), (3, 4, "new")]
    counters = kv(spark, [(1, 5)], "long")
    amounts = kv(spark, [(1, 2), (1, -3), (2, 0)], "long")
    assert pairs(merge.counter_increment(counters, amounts, ["k"], "v")) == [(1, 4), (2, 0)]


def test_conditional(spark):
    target = spark.createDataFrame([(1, "x", "a"), (2, "y", "b"), (3, None, "c")],
                                   "k int, state string, v string")
    asked = spark.createDataFrame([(1, "x", "A"), (2, "x", "B"), (3, "x", "C"), (9, "x", "Z")],
                                  "k int, want string, new string")
    got = merge.conditional_update(target, asked, ["k"], "state", "want", "v", "new")
    assert pairs(got) == [(1, "x", "A"), (2, "y", "b"), (3, None, "c")]
    got = merge.conditional_delete(target, asked, ["k"], "state", "want")
    assert pairs(got) == [(1, None, "a"), (2, "y", "b"), (3, None, "c")]


def test_append_delete_sentinel(spark):
    target = kv(spark, [(1, "a"), (2, None)])
    got = merge.append_value(target, kv(spark, [(1, "bc"), (3, "new")]), ["k"], "v")
    assert pairs(got) == [(1, "abc"), (2, None), (3, "new")]
    assert pairs(merge.delete_by_keys(target, kv(spark, [(1, "")]), ["k"])) == [(2, None)]
    assert merge.truncate(target).schema == target.schema
    assert merge.truncate(target).count() == 0
    assert pairs(merge.null_sentinel(target, ["v"])) == [(1, "a"), (2, "-1000")]


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_numbering(spark, parts):
    rows = spark.createDataFrame([(f"k{i % 7}", i) for i in range(200)], "a string, b int")
    got = merge.number_in_order(rows.repartition(5), ["a", "b"], "n", parts)
    assert [r.n for r in got.orderBy("a", "b").collect()] == list(range(1, 201))


def test_assign_ids(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1), ("b", 1)], "item string, kind int")
    stored = spark.createDataFrame([("a", 2, 7)], "item string, kind int, id long")
    got = merge.assign_ids(rows, stored, ["item", "kind"])
    assert pairs(got) == [(7, "a", 2), (8, "a", 1), (9, "b", 1)]
    assert pairs(merge.assign_ids(rows, stored.limit(0), ["item", "kind"])) == [
        (1, "a", 1), (2, "a", 2), (3, "b", 1)
    ]
    again = merge.assign_ids(rows, got, ["item", "kind"])
    assert pairs(again) == pairs(got)


SPEC = """{"tablename": "t", "columns": {"id": "bigint", "n": "tiny", "on": "bit", "p": "money",
           "q": "numeric", "at": "datetime", "d": "smalldatetime", "s": "nvarchar"}, "rowkey": ["id"]}"""


def test_specs(spark):
    schema, key = casting.schema_from_spec(SPEC)
    assert key == ["id"] and not schema["id"].nullable and schema["s"].nullable
    assert [f.dataType.simpleString() for f in schema] == [
        "bigint", "smallint", "boolean", "double", "decimal(38,10)", "timestamp", "date", "string"
    ]
    assert casting.empty_table(spark, SPEC).schema == schema
    registry = spark.createDataFrame([("t", SPEC)], "name string, spec string")
    got = casting.describe_tables(registry, "spec").orderBy("position").collect()
    assert [r.stored_type for r in got] == [
        "BIGINT", "TINY", "BOOLEAN", "DOUBLE", "DECIMAL", "TIMESTAMP", "DATE", "VARCHAR"
    ]
    assert [r.is_key for r in got] == [True] + [False] * 7


def test_binding(spark):
    cells = spark.createDataFrame(
        [("1", "127", "TRUE"), ("x", "128", "yes"), (None, "-129", None)],
        "a string, b string, c string",
    )
    spec = {"a": "int", "b": "tiny", "c": "bit"}
    assert pairs(casting.cast_by_spec(cells, spec)) == [
        (1, 127, True), (None, None, False), (None, None, None)
    ]
    counts = {r.column_name: (r.n_rows, r.n_ok) for r in casting.type_check(
        cells, {"a": "int", "b": "string", "c": "datetime"}).collect()}
    assert counts == {"a": (3, 1), "b": (3, 3), "c": (3, 0)}


def test_scans(spark):
    rows = [("r1", "x", None), ("r2", "y", 5), ("r3", "z", 9)]
    t = spark.createDataFrame(rows, "k string, b string, a int")
    got = tables.key_range_regex_scan(t, "k", "r1", "r2", ["b", "a"], ["r", "[0-9]$"])
    assert pairs(got) == [("r1", "x"), ("r2", "5,y")]
    assert pairs(tables.column_range_scan(t, "k", "a", 5, 8, ["a"])) == [("r1", ""), ("r2", "5")]
    assert tables.scan(t, ["b"], [F.col("a") > 4, F.col("k") < "r3"]).collect()[0].b == "y"
    assert tables.scan(t).columns == ["k", "b", "a"]
    assert tables.get_row(t, "k", "r3").count() == 1
    assert tables.row_count(t).first().n_rows == 3
