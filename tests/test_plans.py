"""What the physical plans must look like at scale."""

import pytest

from gridtally.operators import hourly, rollup
from workload import queries as Q
from workload import views

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_readings_need_no_sort(spark):
    text = plan(hourly.hour_firsts(Q._clean(spark, SF)))
    assert "SortAggregate" not in text and "partial_min_by" in text


def test_rollups_combine_before_the_shuffle(spark):
    text = plan(rollup.day_rollup(Q._hours(spark, SF)))
    assert "partial_sum" in text and "partial_max_by" in text and "SortAggregate" not in text


def test_window_and_limits_share_one_partitioning(spark):
    """The window over hours reuses the exchange of the limits join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(Q._hours(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_join = text[:text.index("SortMergeJoin")]
    assert "Window" in above_join and "Exchange" not in above_join


def test_scans_read_only_what_they_need(spark):
    text = plan(Q.REGISTRY["scan_project_filter"](spark, SF))
    assert "EqualTo(o_orderstatus,F), GreaterThan(o_totalprice,100000.0)" in text
    read = text[text.index("ReadSchema"):]
    assert "o_orderpriority" not in read and "o_orderdate" not in read


def test_parsing_happens_once(spark):
    text = plan(Q._clean(spark, SF))
    parsed = [line for line in text.splitlines() if "gettimestamp" in line]
    assert len(parsed) == 1 and "Generate inline" in parsed[0]


@pytest.mark.parametrize("name", [n for n in Q.REGISTRY if not n.startswith(("stream", "pipeline"))])
def test_no_cross_joins_and_no_forced_broadcasts(spark, name):
    df = Q.REGISTRY[name](spark, SF)
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_readings_are_a_running_total(spark):
    """The two-level total equals the plain running sum per series."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    plain = Window.partitionBy("x", "event_type").orderBy("ts", "event_id").rowsBetween(
        Window.unboundedPreceding, 0)
    want = views.events(spark, SF).where("event_type = 'click' AND k NOT IN (7, 17, 27)").select(
        "event_id", F.sum("d").over(plain).alias("want"))
    totals = views.events(spark, SF).select("event_id", "event_type", F.sum("d").over(plain).alias("t"))
    got = views.readings(spark, SF).join(totals, "event_id").where(
        "event_type = 'click' AND value IS NOT NULL AND value NOT IN ('NaN', '48,892.60')")
    assert want.count() > 0
    assert got.where(F.col("value").cast("decimal(28,2)") != F.col("t")).count() == 0


def test_queue_and_lookups_do_not_read_the_events_again(spark, tmp_path):
    from datetime import datetime, timedelta

    from gridtally.operators import queue
    from workload.params import NOW

    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=17 * i), i % 13, ("click", "view", "error")[i % 3], 1.5 * i,
             f'{{"k": {i % 50}}}') for i in range(120)]
    rows += [(200, None, 1, "click", 1.0, '{"k": 1}'), (201, start + timedelta(days=9), None, "view", 1.0, '{"k": 1}'),
             (202, start + timedelta(days=9), 3, None, 1.0, '{"k": 1}'), rows[0], rows[5]]
    spark.createDataFrame(
        rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    ).write.parquet(f"{tmp_path}/events.parquet")
    columns = ["building_id", "gate_id", "ts_str"]
    whole = views.readings(spark, str(tmp_path)).select(columns)
    few = views.arrivals(spark, str(tmp_path))
    assert few.exceptAll(whole).count() == 0 and few.count() == whole.count() == 122
    plan = queue.data_access_events(few, NOW)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    for d in (views.meter_dimensions(spark, str(tmp_path)), views.nested_dimensions(spark, str(tmp_path))):
        for lookup in (d.limits, d.codes, d.virtuals, d.item_type):
            assert not [f for f in lookup.inputFiles() if "events.parquet" in f]


def test_queries_queue_without_registers(spark):
    for name in ("data_access_events", "queue_pending"):
        plan = Q.REGISTRY[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "starts" not in plan and "Join" not in plan
