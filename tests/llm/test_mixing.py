"""Mixing against SQL, and the odd cases."""

import pytest

from gridtally.llm import mixing
from gridtally.llm.queries import REGISTRY
from gridtally.llm.sql import oracle_sql
from workload.check import connect, spark_rows, sql_rows


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_is_sql(spark, sf):
    name = "op6_source_mixing"
    assert spark_rows(REGISTRY[name](spark, sf)) == sql_rows(connect(sf), oracle_sql()[name])


def shares(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, out, live = share * sum(sizes.values()), {}, set(names)
    while live:
        total = sum(w[s] for s in live)
        over = {s for s in live if left * w[s] / total > most * sizes[s]}
        if not over:
            out |= {s: left * w[s] / total for s in live}
            break
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in over)
        live -= over
    return out


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1, "é": 400, None: 7, "z": 0}, {"a": 0, None: 0}, {"q": 3}):
        rows = [(s, n) for s, n in sizes.items()]
        got = mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()
        want = shares(sizes)
        assert {r.source: pytest.approx(r.target) for r in got} == want


def test_odd_rows(spark):
    rows = [(1, "a b", "x", 1), (1, "a b", "x", 1), (2, None, None, 2), (None, "", None, 3),
            (3, "c " * 5000, "x", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix long")
    mixed = mixing.mix(docs)
    got = mixed.select("doc_id", "source", "mix.*").collect()
    assert len(got) == 5 and all(r.taken <= 2 * r["size"] for r in got)
    ones = {r.copies for r in got if r.doc_id == 1}
    assert len(ones) == 1
    out = mixing.emit(docs, mixed)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in got)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_taken_is_near_the_target_and_stable(spark):
    docs = spark.range(4000).selectExpr(
        "id AS doc_id", "repeat('w ', cast(id % 97 as int)) AS text",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 20) END AS source")
    first = {r.doc_id: r.mix for r in mixing.mix(docs).collect()}
    again = {r.doc_id: r.mix for r in mixing.mix(docs.repartition(7)).collect()}
    assert first == again
    sums = mixing.mix(docs).groupBy("source").agg({"mix.taken": "sum", "mix.target": "max"})
    for _, taken, target in sums.collect():
        assert abs(taken - target) <= 0.03 * target
