"""Streams and jobs: stream = batch, replays change nothing, backfills win over live rows."""

import random
import time
from decimal import Decimal

import pytest
from helpers import NOW, at, hour_tuples, item_types, limits, reading, readings, records
from pyspark.sql import functions as F

from gridtally.operators import clean, hourly
from gridtally.operators.dims import Dimensions
from gridtally.plans.backfill import backfill, resume
from gridtally.plans.tables import CHANGE, SCHEMAS, SNAPSHOT, MeterTables
from gridtally.schemas import QUEUE_SCHEMA
from gridtally.sources import readings as sources
from gridtally.sources.tables import replace_partitions
from gridtally.streaming import hourly as streams
from gridtally.streaming import ingest, live

ONCE = {"availableNow": True}


@pytest.fixture
def dims(spark):
    frame = spark.createDataFrame
    return Dimensions(
        frame([(1, "B0")], "id int, code string"),
        frame([(1, "G0", 1)], "id int, code string, building_id int"),
        frame([(1, "m0", 1, 11, 100.0, 2.0, 1), (2, "m1", 1, 11, None, None, 2),
               (10, "V", 1, 11, None, None, 3)],
              "id int, code string, collector_id int, data_type int, max_value double,"
              " coefficient double, subentry int"),
        frame([(11, "01-1", "A", "e"), (12, "02-1", "B", "o")],
              "id int, code string, basic_code string, table_name string"),
        frame([(10, "1 + 2")], "item_id int, formula string"),
        frame([(1, "0101"), (2, "01A1"), (3, "01B2")], "id int, code string"),
    )


def random_rows(seed, hours=60, n=300):
    random.seed(seed)
    when = sorted({at(random.randrange(hours), random.randrange(60)) for _ in range(n)})
    rows = []
    for i, t in enumerate(when):
        meter, param = random.choice([("m0", "01-1"), ("m1", "01-1"), ("m1", "02-1")])
        rows.append(reading(meter, t, str(i * random.choice([1, 1, 1, -1]) + 0.25), param))
    return rows


def batch_hours(spark, rows, dims):
    data = clean.clean_readings(readings(spark, rows), dims.item_type, NOW)
    return hour_tuples(hourly.hourly_consumption(data, dims.limits))


def run_stream(spark, tmp_path, build, slices):
    """Feeds slices of records one after the other; returns the emitted hour rows."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in slices:
        records(spark, rows).write.mode("append").parquet(source)
        stream = spark.readStream.schema("value string").parquet(source)
        query = (
            build(sources.decode_readings(stream)).writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start(out)
        )
        query.awaitTermination()
    return hour_tuples(spark.read.schema(spark.read.parquet(out).schema).parquet(out))


SENTINEL = [reading("-", at(24 * 60), "0", "99-9")]


def test_window_stream_equals_batch(spark, tmp_path, dims):
    rows = random_rows(3)
    # The cut falls inside an hour, and one reading arrives late but within the delay.
    early, late = rows[:150], rows[150:]
    late.insert(0, early.pop(-2))
    got = run_stream(
        spark, tmp_path,
        lambda r: streams.hourly_stream(r, dims.item_type, dims.limits, NOW),
        [early, late, SENTINEL],
    )
    assert got == batch_hours(spark, rows, dims)


def test_window_stream_drops_readings_behind_the_watermark(spark, tmp_path):
    none = limits(spark)
    rows = [reading("m", at(h), str(h)) for h in (0, 1, 10, 11)]
    got = run_stream(
        spark, tmp_path, lambda r: streams.hourly_stream(r, item_types(spark), none, NOW),
        [rows, [reading("m", at(2), "2")], SENTINEL],
    )
    assert [h for _, _, h, *_ in got] == [at(0), at(10)]


def test_stream_reports_row_counts(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [reading("m", at(0), "1"), reading("m", at(0), "x"), reading("m", at(1), "2")]
    records(spark, rows).write.parquet(source)
    stream = sources.decode_readings(spark.readStream.schema("value string").parquet(source))
    query = (
        streams.hourly_fold(stream, item_types(spark), limits(spark), now=NOW).writeStream
        .format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start()
    )
    query.awaitTermination()
    seen = [p.observedMetrics["clean_readings"].rows for p in query.recentProgress]
    assert sum(seen) == 2


def test_fold_stream(spark, tmp_path, dims):
    rows = random_rows(4)
    got = run_stream(
        spark, tmp_path, lambda r: streams.hourly_fold(r, dims.item_type, dims.limits, now=NOW),
        [rows[:100], rows[100:130], rows[130:]],
    )
    assert got == batch_hours(spark, rows, dims)


def test_fold_stream_starts_from_a_state(spark, tmp_path):
    none = limits(spark)
    state = spark.createDataFrame(
        [("B0_G0_m", 11, at(4), Decimal("10"))],
        "item_name string, type_id int, date_time timestamp, real_value decimal(31,10)",
    )
    rows = [reading("m", at(5), "12"), reading("m", at(4, 30), "11"), reading("m", at(3), "1")]
    got = run_stream(
        spark, tmp_path,
        lambda r: streams.hourly_fold(r, item_types(spark), none, state, NOW), [rows],
    )
    assert got == [("B0_G0_m", 11, at(4), 2.0, 12.0, 0)]


def tables_of(stored):
    """All result tables as sorted rows.

    Batches that touch the same hour each queue it, and the queue's readers take distinct
    rows; so do we.
    """
    names = [n for n in SCHEMAS if n not in ("amounts", "state", "ranges", "ticks", "ids", "writes")]
    rows = {n: stored.read(n).drop("batch") for n in names}
    rows["queue"] = rows["queue"].distinct()
    return {n: sorted(map(str, df.collect())) for n, df in rows.items()}


def test_live_batches_equal_one_backfill_and_replays_change_nothing(spark, tmp_path, dims):
    rows = random_rows(5, hours=30)
    stored = MeterTables(spark, str(tmp_path / "live")).create()
    slices = [rows[:60], rows[60:90], rows[90:]]
    for n, part in enumerate(slices):
        live.process_batch(records(spark, part), n, stored, dims, NOW)
    once = tables_of(stored)
    live.process_batch(records(spark, slices[-1]), 2, stored, dims, NOW)
    assert tables_of(stored) == once
    assert hour_tuples(stored.read("hour")) == batch_hours(spark, rows, dims)

    whole = MeterTables(spark, str(tmp_path / "backfill"))
    backfill(whole, readings(spark, rows), dims, "20240101000000", "20240501000000", NOW)
    assert tables_of(whole) == once
    assert whole.read("virtual_hour").count() > 0


def test_backfill_in_steps(spark, tmp_path, dims):
    rows = random_rows(6, hours=40)
    one = MeterTables(spark, str(tmp_path / "one"))
    backfill(one, readings(spark, rows), dims, "20240101000000", "20240501000000", NOW)
    two = MeterTables(spark, str(tmp_path / "two"))
    cut = at(17, 30).strftime("%Y%m%d%H%M%S")
    for step, (a, b) in enumerate([("20240101000000", cut), (cut, "20240501000000")]):
        backfill(two, readings(spark, rows), dims, a, b, NOW, step=step)
    assert tables_of(one) == tables_of(two)
    strict = MeterTables(spark, str(tmp_path / "strict"))
    backfill(strict, readings(spark, rows), dims, "20240101000000", "20240501000000", NOW,
             queue_from="hour_rows")
    emitted = {(r.date_time,) for r in strict.read("hour").select("date_time").collect()}
    assert {(r.date_time,) for r in strict.read("virtual_hour").collect()} <= emitted
    assert tables_of(strict)["hour"] == tables_of(one)["hour"]
    with pytest.raises(ValueError):
        backfill(one, readings(spark, rows), dims, "20240501000000", "20240101000000", NOW)


def test_overlapping_backfills_keep_the_rest_and_the_seam(spark, tmp_path, dims):
    rows = [reading("m0", at(h), str(h)) for h in range(24)]
    one = MeterTables(spark, str(tmp_path / "one"))
    backfill(one, readings(spark, rows), dims, "20240301000000", "20240302000000", NOW)
    two = MeterTables(spark, str(tmp_path / "two"))
    for start, end in [("20240301000000", "20240302000000"), ("20240301120000", "20240302000000"),
                       ("20240301060000", "20240301083000")]:
        backfill(two, readings(spark, rows), dims, start, end, NOW)
    days = [at(0).date()]
    assert hour_tuples(one.hours(days)) == hour_tuples(two.hours(days))
    for name in ("day", "month", "subentry_hour", "subentry_day", "virtual_hour"):
        assert sorted(map(str, one.read(name).collect())) == sorted(map(str, two.read(name).collect()))


def test_recompute_empties_what_has_no_rows_now(spark, tmp_path, dims):
    good = [reading("m0", at(h), str(h)) for h in range(5)]
    stored = MeterTables(spark, str(tmp_path / "t"))
    span = ("20240301000000", "20240302000000", NOW)
    backfill(stored, readings(spark, good), dims, *span)
    assert stored.read("virtual_hour").count() > 0 and stored.read("day").count() > 0
    # in the corrected history the meter runs backwards, so no hour is valid
    bad = [reading("m0", at(h), str(100 - h)) for h in range(5)]
    backfill(stored, readings(spark, bad), dims, *span)
    fresh = MeterTables(spark, str(tmp_path / "fresh"))
    backfill(fresh, readings(spark, bad), dims, *span)
    for name in ("virtual_hour", "day", "month", "subentry_hour", "subentry_day"):
        assert sorted(map(str, stored.read(name).collect())) == sorted(map(str, fresh.read(name).collect()))
    # and then there is no reading at all
    run = backfill(stored, readings(spark, []), dims, *span)
    days = [at(0).date()]
    assert stored.hours(days).count() == stored.read("day").count() == stored.read("month").count() == 0
    # a step that runs again leaves none of its own old rows either
    backfill(stored, readings(spark, good), dims, *span, run=run)
    backfill(stored, readings(spark, []), dims, *span, run=run)
    assert stored.hours(days).count() == 0 and stored.read("queue").where(
        f"batch = {stored.newest_batch('queue')}").count() == 0


def test_live_goes_on_with_the_newest_state(spark, tmp_path, dims):
    stored = MeterTables(spark, str(tmp_path / "t")).create()
    live.process_batch(records(spark, [reading("m1", at(0), "1")]), 3, stored, dims, NOW)
    live.process_batch(records(spark, [reading("m1", at(1), "5")]), 7, stored, dims, NOW)
    assert [t[3] for t in hour_tuples(stored.read("hour"))] == [4.0]


def test_an_arrival_of_many_files_is_one_batch(spark, tmp_path, dims):
    rows = random_rows(8)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, part in enumerate([rows[150:], rows[:150]]):  # later readings in older files
        records(spark, part).repartition(40).write.mode("append").parquet(source)
    records(spark, SENTINEL).write.mode("append").parquet(source)
    stream = spark.readStream.schema("value string").parquet(source)
    streams.hourly_fold(sources.decode_readings(stream), dims.item_type, dims.limits, now=NOW) \
        .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")) \
        .trigger(**ONCE).start(out).awaitTermination()
    assert hour_tuples(spark.read.parquet(out)) == batch_hours(spark, rows, dims)


def test_backfill_wins_over_live_rows(spark, tmp_path, dims):
    stored = MeterTables(spark, str(tmp_path / "t")).create()
    wrong = [reading("m1", at(0), "1"), reading("m1", at(1), "500"), reading("m1", at(2), "501")]
    right = [reading("m1", at(0), "1"), reading("m1", at(1), "5"), reading("m1", at(2), "7")]
    live.process_batch(records(spark, wrong), 0, stored, dims, NOW)
    backfill(stored, readings(spark, right), dims, "20240301000000", "20240302000000", NOW)
    assert [t[3] for t in hour_tuples(stored.hours([at(0).date()]))] == [4.0, 2.0]
    assert float(stored.read("day").where("item_name = 'B0_G0_m1'").first().value) == 6.0


def test_ingest_is_complete_and_replayable(spark, tmp_path):
    rows = [reading("m", at(1), "1"), reading("m", at(1), "x"), reading("m", "junk", "1")]
    data = records(spark, rows).union(spark.createDataFrame([("{broken",)], "value string"))
    root = str(tmp_path / "t")
    for _ in range(2):
        ingest.write_batch(data, 0, root, NOW)
    ingest.write_batch(records(spark, rows[:1]), 1, root, NOW)
    kinds = spark.read.parquet(root).groupBy("kind").count()
    assert {r.kind: r["count"] for r in kinds.collect()} == {"history": 2, "quarantine": 3}
    raw = {r.raw for r in spark.read.parquet(root).where("kind = 'quarantine'").collect()}
    assert "{broken" in raw and len(raw) == 3 and None not in raw


def test_json_round_trip(spark):
    rows = readings(spark, [reading("m", at(1), None), reading('q"', None, "1,5")])
    again = sources.decode_readings(sources.encode_readings(rows))
    assert again.collect() == rows.collect()
    broken = spark.createDataFrame([("[1,",), ("[1, null, 2.5]",)], "value string")
    got = sources.decode_readings(broken).collect()
    assert set(got[0]) == {None}
    assert tuple(got[1][:4]) == ("1", None, "2.5", None)


def test_history_is_pruned_by_day(spark, tmp_path):
    rows = readings(spark, [reading("m", at(h), str(h)) for h in range(0, 96, 2)])
    path = str(tmp_path / "history")
    replace_partitions(sources.with_day(rows), path, ["day"])
    stored = spark.read.parquet(path)
    got = sources.history_range_scan(stored, "20240302060000", "2024-03-03 00:00:00")
    assert got.count() == sources.history_range_scan(
        rows, "20240302060000", "20240303000000"
    ).count() == 9
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    before = {r.f for r in stored.select(F.input_file_name().alias("f")).distinct().collect()}
    time.sleep(0.01)
    replace_partitions(sources.with_day(rows.where("ts_str < '20240302'")), path, ["day"])
    after = {r.f for r in spark.read.parquet(path).select(
        F.input_file_name().alias("f")).distinct().collect()}
    assert len(before & after) == 3 and spark.read.parquet(path).count() == 48


def reports(spark, rows):
    """Queue rows of (hour, type) of the one collector."""
    return spark.createDataFrame(
        [("B0", "G0", at(h).strftime("%Y%m%d%H"), t) for h, t in rows], QUEUE_SCHEMA)


def buckets_of(stored, name="subentry_hour"):
    return {r.data_time: (float(r.electricity), float(r.electricity_a)) for r in stored.read(name).collect()}


def test_third_party_reports_count_once(spark, tmp_path, dims):
    # m0 counts twice its register (electricity), m1 once (electricity_a); one step an hour
    slices = [[reading(m, at(h), str(h)) for h in hours for m in ("m0", "m1")]
              for hours in (range(0, 4), range(4, 7), range(7, 9))]
    plain = MeterTables(spark, str(tmp_path / "plain")).create()
    stored = MeterTables(spark, str(tmp_path / "third")).create()
    for n, part in enumerate(slices):
        if n == 0:
            stored.report(reports(spark, [(1, 2), (1, 2), (5, 2), (2, 2), (2, 3), (40, 2)]), 0)
        if n == 2:
            stored.report(reports(spark, [(1, 2), (6, 2)]), 1)  # the first of them again
        for t in (plain, stored):
            live.process_batch(records(spark, part), n, t, dims, NOW)
        once = tables_of(stored)
        live.process_batch(records(spark, part), n, stored, dims, NOW)
        assert tables_of(stored) == once
    marks = {(r.timestamp, r.batch) for r in stored.read("marks").collect()}
    assert marks == {(at(1).strftime("%Y%m%d%H"), 0), (at(5).strftime("%Y%m%d%H"), 1),
                     (at(6).strftime("%Y%m%d%H"), 2)}
    own, both = buckets_of(plain), buckets_of(stored)
    for hour, amounts in own.items():
        more = (2.0, 1.0) if hour in (at(1), at(5), at(6)) else (0.0, 0.0)
        assert both[hour] == (amounts[0] + more[0], amounts[1] + more[1])
    day, more = buckets_of(plain, "subentry_day")[at(0)], buckets_of(stored, "subentry_day")[at(0)]
    assert more == (day[0] + 6.0, day[1] + 3.0)
    # a backfill over the same day keeps them
    backfill(stored, readings(spark, sum(slices, [])), dims, "20240301000000", "20240302000000", NOW)
    assert buckets_of(stored) == both


def test_old_reports_expire_and_keep_their_amounts(spark, tmp_path, dims):
    stored = MeterTables(spark, str(tmp_path / "t")).create()
    first = [reading("m0", at(h), str(h)) for h in range(4)]
    stored.report(reports(spark, [(1, 2), (24 * 400, 2)]), 0)
    live.process_batch(records(spark, first), 0, stored, dims, NOW)
    amounts = buckets_of(stored)
    assert stored.read("marks").count() == 1 and amounts[at(1)] == (4.0, 0.0)
    late = [reading("m0", at(24 * 400 + h), str(h)) for h in range(2)]
    live.process_batch(records(spark, late), 1, stored, dims, "2026-01-01 00:00:00")
    assert [r.batch for r in stored.read("marks").collect()] == [1]
    assert stored.read("queue").where("type = 2").count() == 1
    stored.refresh(dims, [at(0).date()])
    assert buckets_of(stored)[at(1)] == (4.0, 0.0)


def test_state_log_writes_what_a_batch_touched(spark, tmp_path):
    stored = MeterTables(spark, str(tmp_path / "t"), snapshot_every=2).create()
    batches = [[(f"m{k}", 0, 1) for k in range(20)]]
    batches += [[(f"m{n}", n, n), ("m0", n, n)] for n in range(1, 6)]
    want, after = {}, []
    for n, rows in enumerate(batches):
        amounts = spark.createDataFrame([(m, 11, at(h), Decimal(v)) for m, h, v in rows],
                                        "item_name string, type_id int, hour timestamp, amount decimal(31,10)")
        for _ in range(1 + (n == 4)):  # the fifth batch runs again after its snapshot
            stored.write_changes(hourly.last_known(amounts, stored.state(n - 1, only=amounts)), n)
        want.update({m: (at(h), float(v)) for m, h, v in rows})
        after.append(dict(want))
    for n in (4, 5):
        assert {r.item_name: (r.date_time, float(r.real_value)) for r in stored.state(n).collect()} == after[n]
    log = stored.read("state").groupBy("kind", "batch").count().collect()
    assert all(r["count"] <= 2 for r in log if r.kind == CHANGE)
    # what neither the last batch nor a replay of it reads is gone
    assert sorted(r.batch for r in log if r.kind == SNAPSHOT) == [3, 5]
    assert min(r.batch for r in log) == 3


def test_dimensions_are_read_for_every_batch(spark, tmp_path, dims):
    source, item = str(tmp_path / "in"), str(tmp_path / "item")
    dims.item.where("id <> 10 and id <> 2").write.parquet(item)

    def now_known():
        return Dimensions(dims.building, dims.collector, spark.read.parquet(item), dims.item_type,
                          dims.item_virtual, dims.subentry)

    for n, hours in enumerate([range(0, 3), range(3, 6)]):
        if n:
            dims.item.where("id = 10 or id = 2").write.mode("append").parquet(item)
        records(spark, [reading(m, at(h), str(h)) for h in hours for m in ("m0", "m1")]) \
            .write.mode("append").parquet(source)
        stream = spark.readStream.schema("value string").parquet(source)
        live.start_live(stream, str(tmp_path / "t"), str(tmp_path / "cp"), now_known, NOW,
                        trigger=ONCE).awaitTermination()
        rows = MeterTables(spark, str(tmp_path / "t")).read("virtual_hour").collect()
        assert bool(rows) == bool(n)


def test_resume_computes_what_is_missing(spark, tmp_path, dims, monkeypatch):
    rows = random_rows(9, hours=40, n=250)
    span = ("20240301000000", "20240302160000")
    one = MeterTables(spark, str(tmp_path / "one"))
    backfill(one, readings(spark, rows), dims, *span, NOW)
    two = MeterTables(spark, str(tmp_path / "two"))
    cuts = [at(h).strftime("%Y%m%d%H%M%S") for h in (0, 9, 20, 31, 40)]
    for step in (0, 2):
        backfill(two, readings(spark, rows), dims, cuts[step], cuts[step + 1], NOW, step=step)
    # a step that dies before its tables are refreshed is not done
    monkeypatch.setattr(MeterTables, "refresh", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        backfill(two, readings(spark, rows), dims, cuts[3], cuts[4], NOW, step=3)
    monkeypatch.undo()
    assert two.missing(*span) == [("2024-03-01 09:00:00", "2024-03-01 20:00:00"),
                                  ("2024-03-02 07:00:00", "2024-03-02 16:00:00")]
    runs = resume(two, readings(spark, rows), dims, *span, now=NOW)
    assert len(runs) == 2 and two.missing(*span) == []
    assert resume(two, readings(spark, rows), dims, *span, now=NOW) == []
    days = [at(0).date(), at(24).date()]
    assert hour_tuples(one.hours(days)) == hour_tuples(two.hours(days))
    for name in ("day", "month", "subentry_hour", "subentry_day", "virtual_hour"):
        assert sorted(map(str, one.read(name).collect())) == sorted(map(str, two.read(name).collect()))


def test_fold_hands_on_one_row_per_hour(spark, monkeypatch):
    import pandas as pd

    schema = "item_name string, type_id int, ts_us long, hour_us long, pos long, amount string"
    rng = random.Random(2)
    rows = [("m", 11, t := rng.randrange(500), t // 100, rng.randrange(9), str(n)) for n in range(400)]
    rows += [(f"m{n}", 11, 5, 0, 0, "x") for n in range(5)]
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    chunks = [frame[n:n + 60] for n in range(0, len(frame), 60)]
    got = pd.concat(streams._firsts(schema)(iter(chunks)))
    assert len(got) == 5 + 5
    for r in got[got.item_name == "m"].itertuples():
        assert (r.ts_us, r.pos) == min((x[2], x[4]) for x in rows if x[0] == "m" and x[3] == r.hour_us)
    monkeypatch.setattr(streams, "HELD", 3)
    parts = list(streams._firsts(schema)(iter(chunks)))
    assert len(parts) > 2 and max(map(len, parts)) <= 10 and set(pd.concat(parts).item_name) == set(frame.item_name)


def test_fold_plan_reduces_before_the_exchange(spark, tmp_path, dims):
    source = str(tmp_path / "in")
    records(spark, random_rows(1, n=20)).write.parquet(source)
    stream = sources.decode_readings(spark.readStream.schema("value string").parquet(source))
    folded = streams.hourly_fold(stream, dims.item_type, dims.limits, now=NOW)
    plan = folded._jdf.queryExecution().analyzed().toString()
    assert plan.index("FlatMapGroupsInPandasWithState") < plan.index("MapInPandas")


def test_ids_are_stable_and_writes_are_counted(spark, tmp_path, dims):
    stored = MeterTables(spark, str(tmp_path / "t")).create()
    batches = [["m0", "m3"], ["m1", "m0"], ["m0"], ["m9", "m2", "m1"]]
    for n, meters in enumerate(batches):
        for _ in range(1 + n % 2):  # some run twice
            rows = [reading(m, at(n), str(n)) for m in meters]
            live.process_batch(records(spark, rows), n, stored, dims, NOW, refresh=False, ids=True)
    ids = {r.item_name: r.id for r in stored.read("ids").collect()}
    assert ids == {"B0_G0_m0": 1, "B0_G0_m3": 2, "B0_G0_m1": 3, "B0_G0_m2": 4, "B0_G0_m9": 5}
    counts = {(r.batch, r.table_name): r.n_rows for r in stored.read("writes").collect()}
    assert [counts[n, "state"] for n in range(4)] == [2, 2, 1, 3]
    assert [counts[n, "ids"] for n in range(4)] == [2, 1, 0, 2]
    hours = stored.read("hour").groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in hours} == {n: counts[n, "hour"] for n in range(4) if counts[n, "hour"]}
    stored.refresh(dims, [at(0).date()])
    stored.write_counts(3, [at(0).date()])
    counts = {r.table_name: r.n_rows for r in stored.read("writes").where("batch = 3").collect()}
    assert counts["day"] == stored.read("day").count() > 0 and counts["state"] == 3


def test_progress_table_has_late_rows(spark, tmp_path):
    from gridtally.streaming.progress import ProgressTable

    path = str(tmp_path / "progress")
    listener = ProgressTable(spark, path)
    spark.streams.addListener(listener)
    try:
        rows = [reading("m", at(h), str(h)) for h in (0, 1, 10, 11)]
        run_stream(spark, tmp_path,
                   lambda r: streams.hourly_stream(r, item_types(spark), limits(spark), NOW),
                   [rows, [reading("m", at(2), "2"), reading("m", at(12), "12")]])
        for _ in range(100):
            time.sleep(0.2)
            if (tmp_path / "progress").exists() and spark.read.parquet(path).count() >= 2:
                break
        got = spark.read.parquet(path).orderBy("run_id").collect()
    finally:
        spark.streams.removeListener(listener)
    assert sorted((r.input_rows, r.late_rows) for r in got) == [(2, 1), (4, 0)]
    assert all('"clean_readings": {"rows":' in r.metrics for r in got)
