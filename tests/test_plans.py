"""The plans that matter at scale: what is scanned, shuffled and broadcast."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import anomaly, cleaning, joins, kpi, ordered, quantiles, reshape, stats
from gridpulse.plans import catalog, registry
from gridpulse.plans.views import Tables


@pytest.fixture(scope="module")
def t(spark, sf):
    return Tables(spark, sf)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_view_filter_reaches_the_scan(t):
    df = reshape.apply_filters(t.events.withColumnRenamed("ts", "timestamp"), start=None, end=date(2024, 1, 10))
    assert re.search(r"PushedFilters: \[.*LessThanOrEqual\(ts", plan(df))


def test_scan_reads_only_needed_columns(t):
    text = plan(stats.group_mean(t.traffic, ["area"], ["vehicle_count"]))
    assert re.search(r"ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>", text)


def test_group_means_combine_before_the_shuffle(t):
    assert "partial_avg" in plan(stats.group_mean(t.traffic, ["area"], ["vehicle_count"]))


def test_rules_are_one_scan(t):
    assert plan(cleaning.violations(t.traffic, cleaning.rules("traffic"))).count("FileScan") == 1


def test_profile_is_one_scan(t):
    assert plan(cleaning.missing_profile(t.dirty)).count("FileScan") == 1


def test_no_cross_joins_or_nested_loops(t):
    frames = [
        anomaly.z_scores(t.events, "value"), kpi.city_score(t.traffic.withColumn("incident", F.lit("x")), t.energy, t.pollution),
        stats.histogram(t.events, "value", 20), stats.density_curve(t.events, "value", by="event_type"),
        cleaning.cap_outliers(t.lineitem, cleaning.iqr_bounds(t.lineitem, ["l_quantity"])),
        joins.with_holiday_multiplier(t.energy, "timestamp"), kpi.alerts(t.traffic, t.energy, t.pollution),
    ]
    for df in frames:
        assert "NestedLoop" not in plan(df) and "CartesianProduct" not in plan(df)


def test_fixed_dimensions_are_broadcast(t):
    assert "BroadcastHashJoin" in plan(joins.with_area_dimension(t.energy.select("reading_id", "area")))


def test_row_numbers_sort_no_table_in_one_task(t):
    text = plan(ordered.row_numbers(t.events.select("event_id", "ts"), ["ts", "event_id"]))
    # the only single-partition exchange orders the per-partition counts
    assert text.count("Exchange SinglePartition") == 1
    assert "Window" in text and "_rows" in text.split("Window")[1]


def test_segmented_windows_shuffle_by_segment(t):
    frame = ordered.OrderedFrame.of(t.events, [], ["ts", "event_id"], max_group_rows=0, segment_rows=100)
    out = frame.windows({"m": lambda w: F.avg("value").over(w.rowsBetween(-2, 2))}, 2, 2).result()
    assert re.search(r"hashpartitioning\(_seg", plan(out))


def test_split_is_a_pushed_filter(t):
    train, _ = quantiles.chronological_split(t.events, ["ts", "event_id"], 0.8)
    text = plan(train)
    assert "PushedFilters: [" in text and "Exchange" not in text and "Sort" not in text


def test_top_groups_take_ordered(t):
    assert "TakeOrderedAndProject" in plan(stats.top_groups(t.traffic, "area", {"m": F.avg("vehicle_count")}, "m", 8))


def test_scalars_do_not_shuffle_the_rows(t):
    text = plan(anomaly.z_scores(t.events.select("event_id", "value"), "value"))
    assert text.count("Exchange") == text.count("Exchange SinglePartition")  # only inside the sub-query


def test_methods_too_long_for_the_jvm_are_not_generated(spark, sf):
    catalog.load()
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    registry.run("d01_row_count", spark, sf)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
