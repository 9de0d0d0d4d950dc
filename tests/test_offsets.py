"""Starting offsets and batches of a partitioned log."""

import json

import pytest

from gridtally.operators import offsets


def table(spark, rows):
    return spark.createDataFrame(rows, "partition int, offset long")


def starts(spark, recorded, beginnings):
    got = offsets.starting_offsets(table(spark, recorded), table(spark, beginnings))
    return {r.partition: r.offset for r in got.collect()}


@pytest.mark.parametrize("recorded, want", [
    ([], {0: 10, 1: 0, 2: 5}),                              # nothing recorded
    ([(0, 12), (1, 3), (2, 5)], {0: 12, 1: 3, 2: 5}),       # all valid, one exactly at its beginning
    ([(0, 12), (1, 3), (2, 4)], {0: 10, 1: 0, 2: 5}),       # one aged out: all from their beginnings
    ([(0, 0), (1, 3)], {0: 10, 1: 3, 2: 5}),                # 0 and no record are no loss
    ([(0, 12), (0, 30), (1, None), (9, 1)], {0: 30, 1: 0, 2: 5}),
])
def test_starting_offsets(spark, recorded, want):
    assert starts(spark, recorded, [(0, 10), (1, 0), (2, 5)]) == want


def test_empty_log(spark):
    assert starts(spark, [(0, 5)], []) == {}


def test_batches_are_bounded_and_lose_nothing(spark):
    log = [(p, o) for p, a, b in [(0, 10, 48), (1, 0, 3), (2, 7, 20)] for o in range(a, b)]
    begun = table(spark, [(0, 12), (1, 3), (2, 7)])
    got = offsets.remaining(table(spark, log), begun, 10).collect()
    assert sorted((r.partition, r.offset) for r in got) == sorted(
        x for x in log if x[1] >= {0: 12, 1: 3, 2: 7}[x[0]])
    sizes = {}
    for r in got:
        sizes[r.partition, r.batch] = sizes.get((r.partition, r.batch), 0) + 1
    assert max(sizes.values()) == 10 and {b for _, b in sizes} == {0, 1, 2, 3}
    order = sorted((r.partition, r.offset, r.batch) for r in got)
    assert all(x[2] <= y[2] for x, y in zip(order, order[1:], strict=False) if x[0] == y[0])
    assert {r.batch for r in offsets.remaining(table(spark, log), begun).collect()} == {0}
    with pytest.raises(ValueError):
        offsets.remaining(table(spark, log), begun, 0)


def test_recording_and_going_on_reads_every_row_once(spark):
    log = table(spark, [(p, o) for p in range(3) for o in range(20)])
    beginnings = table(spark, [(p, 0) for p in range(3)])
    seen, recorded = [], table(spark, [])
    for _ in range(4):
        begun = offsets.starting_offsets(recorded, beginnings)
        part = offsets.remaining(log, begun, 7).where("batch = 0").drop("batch")
        seen += [tuple(r) for r in part.collect()]
        done = offsets.next_offsets(part).collect()
        recorded = table(spark, [tuple(r) for r in recorded.collect()] + [tuple(r) for r in done])
    assert len(seen) == len(set(seen)) == 60


def test_json_for_kafka(spark):
    row = offsets.as_json(table(spark, [(1, 7), (0, 3_000_000_000)]), "meters").first()
    assert json.loads(row.offsets) == {"meters": {"0": 3_000_000_000, "1": 7}}
