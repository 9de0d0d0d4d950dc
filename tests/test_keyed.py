"""Keyed tables: lookups give what a scan gives, and open few files."""

import random

import pytest
from pyspark.sql import functions as F

from gridtally.sources import keyed


@pytest.fixture
def table(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"K{rng.randrange(3000):05d}", n) for n in range(8000)] + [("K01500", n) for n in range(500)]
    rows += [(None, -1), (None, -2)]
    df = spark.createDataFrame(rows, "`row.key` string, n int").repartition(7)
    keyed.write_keyed(df, str(tmp_path / "t"), "row.key", 16)
    return str(tmp_path / "t"), rows


def found(df):
    return sorted(((r[0] or "", r[1]) for r in df.collect()))


def opened(df):
    return len(df.select(F.input_file_name()).distinct().collect())


def test_lookups_are_scans_of_few_files(spark, table):
    path, rows = table
    every = spark.read.parquet(f"{path}/data")
    assert found(every) == sorted((k or "", n) for k, n in rows) and len(every.inputFiles()) == 16
    for values in (["K00007"], ["K01500", "K02999", "none", None], [], [None]):
        got = keyed.get_rows(spark, path, "row.key", values)
        assert found(got) == sorted((k, n) for k, n in rows if k is not None and k in values)
        if values and values != [None]:
            assert len(got.inputFiles()) <= 2 * len(values)
    for low, high in (("K00100", "K00130"), (None, "K00050"), ("K02950", None), ("x", "y"), ("K2", "K1"), (None, None)):
        got = keyed.get_range(spark, path, "row.key", low, high)
        assert found(got) == sorted((k, n) for k, n in rows if k is not None and (low is None or k >= low)
                                    and (high is None or k <= high))
    assert len(keyed.get_range(spark, path, "row.key", "K00100", "K00130").inputFiles()) <= 2


def test_writing_again_replaces(spark, table):
    path, _ = table
    df = spark.createDataFrame([("a", 1)], "`row.key` string, n int")
    keyed.write_keyed(df, path, "row.key", 4)
    assert found(keyed.get_range(spark, path, "row.key", None, None)) == [("a", 1)]
    keyed.write_keyed(df.limit(0), path, "row.key", 4)
    assert keyed.get_rows(spark, path, "row.key", ["a"]).collect() == []
