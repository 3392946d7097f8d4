"""Missing values, NaN, missing keys and hot keys give the same results on every path."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridpulse.operators import anomaly, joins, quantiles, reshape, stats
from gridpulse.operators.ordered import OrderedFrame

SPLIT = {"max_group_rows": 0, "segment_rows": 7}


def gaps(spark, n=260, seed=3):
    """A hot key, a missing key, a key without any value, and long runs of missing values."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        key = None if i % 11 == 0 else "none" if i % 13 == 0 else "hot" if i % 3 else f"k{i % 5}"
        missing = key == "none" or 40 <= i < 120 or rng.random() < 0.2
        rows.append((key, i, None if missing else float(rng.normal(100, 20))))
    return spark.createDataFrame(rows, "k string, t long, v double")


def ordered(frame):
    return frame.toPandas().sort_values("t", ignore_index=True)


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("weight", [0.32, 0.01])
def test_smoothing_split_equals_plain_over_gaps(spark, keys, weight):
    df = gaps(spark)
    plain, split = (OrderedFrame.of(df, keys, ["t"], **s).smooth("v", "out", weight, 4000.0).result() for s in ({}, SPLIT))
    pd.testing.assert_frame_equal(ordered(plain), ordered(split.select(*plain.columns)), rtol=1e-9)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_sum_split_equals_plain_over_gaps(spark, keys):
    df = gaps(spark)
    plain, split = (OrderedFrame.of(df, keys, ["t"], **s).running_sum("v", "out").result() for s in ({}, SPLIT))
    pd.testing.assert_frame_equal(ordered(plain), ordered(split.select(*plain.columns)), rtol=1e-9)


def test_frames_longer_than_a_segment(spark):
    columns = {"m": lambda w: F.sum("v").over(w.rowsBetween(-20, 9))}
    plain, split = (OrderedFrame.of(gaps(spark), ["k"], ["t"], **s).windows(columns, 20, 9).result() for s in ({}, SPLIT))
    pd.testing.assert_frame_equal(ordered(plain), ordered(split.select(*plain.columns)), rtol=1e-9)


def test_quantiles_keep_groups_without_values(spark):
    df = gaps(spark)
    found = [quantiles.exact_quantiles(df, ["v"], [0.25, 0.5], ["k"], n).toPandas().sort_values("k", ignore_index=True) for n in (10 ** 6, 20)]
    for a, b in zip(found[0].itertuples(), found[1].itertuples()):
        assert a.k == b.k or (pd.isna(a.k) and pd.isna(b.k))
        np.testing.assert_allclose(np.array(a.v, float), np.array(b.v, float))
    assert len(found[0]) == len(found[1]) == df.select("k").distinct().count()


@pytest.mark.parametrize("limit", [10 ** 6, 5])
@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.8])
def test_split_keeps_rows_without_a_time(spark, limit, fraction):
    rows = [(i, None if i % 3 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    early, late = quantiles.chronological_split(df, ["ts", "id"], fraction, limit)
    want = [i for i, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[0]))]
    n = int(40 * fraction)
    assert {r["id"] for r in early.collect()} == set(want[:n]) and {r["id"] for r in late.collect()} == set(want[n:])


def test_density_without_spread_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 5.0), ("b", 2.0), (None, 4.0), (None, 1.0), ("a", float("nan"))], "k string, v double")
    got = stats.density_curve(df, "v", by="k").toPandas()
    assert got[got.k == "b"].density.isna().all() and got[got.k == "a"].density.notna().all() and got[got.k.isna()].density.notna().all()
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert stats.density_curve(same, "v").where("density is not null").count() == 0
    bins = stats.histogram(df, "v", 4).toPandas().sort_values("bin")
    assert bins.n.tolist() == [2, 1, 1, 2] and bins.left_edge.tolist() == [1.0, 2.0, 3.0, 4.0]
    assert stats.group_mean(df, ["k"], ["v"]).where("k = 'a'").first()["avg_v"] == 3.0


def test_missing_key_is_a_group(spark):
    rows = [(None, i, 1000.0 if i == 20 else float(i % 3)) for i in range(40)] + [("a", i, float(i % 4)) for i in range(40, 60)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    flagged = anomaly.detect_anomalies(df, "v", ["t"], ["k"]).where("is_anomaly").collect()
    assert [r["t"] for r in flagged] == [20]
    assert stats.box_stats(df, "k", "v").count() == 2
    assert anomaly.z_scores(df.withColumn("v", F.when(F.col("t") == 3, F.lit(float("nan"))).otherwise(F.col("v"))), "v").where(
        "zscore is not null and not isnan(zscore)").count() == 59


def test_event_that_ends_before_it_begins_matches_nothing(spark):
    events = spark.sql("SELECT 'a' AS area, date'2024-01-05' AS first, date'2024-01-03' AS last, 2.0D AS multiplier")
    df = spark.sql("SELECT 'a' AS area, timestamp_ntz'2024-01-04 10:00:00' AS ts")
    assert joins.with_event_multiplier(df, events, "area", "ts").first()["event_multiplier"] == 1.0


def test_history_is_whole_unless_asked(spark):
    history = spark.range(30).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS ts")
    assert reshape.merge_history(history, None, "ts", ["id"]).count() == 30
    assert reshape.merge_history(history, None, "ts", ["id"], keep=4).count() == 4
