"""Segmented windows must equal plain ones, whatever the key sizes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridpulse.operators.ordered import OrderedFrame, centred_frame, lag_features, rolling, row_numbers

SIZES = {"max_group_rows": 0, "segment_rows": 7}


def hot_rows(seed: int, n: int = 200) -> pd.DataFrame:
    """A third of all rows under one key, some keys with a single row, gaps in the values."""
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.34, "hot", np.char.add("k", rng.integers(0, 40, n).astype(str)))
    value = rng.normal(size=n)
    value[rng.random(n) < 0.5] = np.nan
    return pd.DataFrame({"k": keys, "t": rng.integers(0, 50, n), "id": rng.permutation(n), "v": value})


def frame(spark, pdf: pd.DataFrame):
    return spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_windows_split_equals_plain(spark, seed, keys):
    df = frame(spark, hot_rows(seed))
    columns = {
        "l1": lambda w: F.lag("v", 1).over(w),
        "l3": lambda w: F.lag("v", 3).over(w),
        "m": lambda w: F.count("v").over(w.rowsBetween(-3, 2)),
        "lead": lambda w: F.lead("id", 2).over(w),
    }
    plain = OrderedFrame.of(df, keys, ["t", "id"]).windows(columns, 3, 2)
    split = OrderedFrame.of(df, keys, ["t", "id"], **SIZES).windows(columns, 3, 2)
    assert not plain.split and split.split
    pd.testing.assert_frame_equal(*[
        x.result().toPandas().sort_values("id", ignore_index=True) for x in (plain, split)])


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_fill_and_running_sum_split_equals_plain(spark, seed, keys):
    df = frame(spark, hot_rows(seed)).withColumn("w", F.col("id") % 5)
    out = []
    for sizes in ({}, SIZES):
        o = OrderedFrame.of(df, keys, ["t", "id"], **sizes).forward_fill(["v"]).running_sum("w", "cum")
        out.append(o.result().toPandas().sort_values("id", ignore_index=True))
    pd.testing.assert_frame_equal(*out)


def test_null_key_is_a_group_of_its_own(spark):
    df = spark.createDataFrame([(None, i, float(i)) for i in range(20)] + [("a", i, 1.0) for i in range(20)], "k string, t int, v double")
    out = OrderedFrame.of(df, ["k"], ["t"], **SIZES).running_sum("v", "c").result()
    assert out.filter("k is null").agg(F.max("c")).first()[0] == sum(range(20))
    assert out.filter("k = 'a'").agg(F.max("c")).first()[0] == 20


@pytest.mark.parametrize("rows", [0, 1, 4])
def test_small_frames(spark, rows):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(rows)], "area string, t int, v double")
    for sizes in ({}, SIZES):
        got = lag_features(df, "area", ["t"], "v", {"l1": 1, "l2": 2}, **sizes).orderBy("t").collect()
        assert [r["l1"] for r in got] == [float(max(i - 1, 0)) for i in range(rows)]
        assert [r["l2"] for r in got] == [float(max(i - 2, 0)) for i in range(rows)]


def test_row_numbers_with_one_hot_time(spark):
    df = spark.range(500).select((F.col("id") % 3 > 0).cast("int").alias("t"), "id")
    got = row_numbers(df, ["t", "id"]).orderBy("row_num").toPandas()
    want = df.toPandas().sort_values(["t", "id"], ignore_index=True)
    assert got["row_num"].tolist() == list(range(1, 501))
    assert got["id"].tolist() == want["id"].tolist()


@pytest.mark.parametrize("n", [6, 7, 24, 25])
def test_centred_rolling_equals_pandas(spark, n):
    pdf = hot_rows(5, 120)
    want = pdf.sort_values(["t", "id"], ignore_index=True)
    r = want["v"].rolling(n, min_periods=3, center=True)
    got = rolling(frame(spark, pdf), "v", n, ["t", "id"], max_group_rows=0, segment_rows=30).toPandas()
    got = got.sort_values(["t", "id"], ignore_index=True)
    np.testing.assert_allclose(got["roll_mean"], r.mean(), atol=1e-9)
    np.testing.assert_allclose(got["roll_std"], r.std(), atol=1e-7)
    assert sum(centred_frame(n)) == n - 1


@pytest.mark.parametrize("n, segment", [(24, 5), (25, 1), (60, 7), (500, 30)])
def test_frame_longer_than_a_segment_equals_pandas(spark, n, segment):
    pdf = hot_rows(6, 120)
    want = pdf.sort_values(["t", "id"], ignore_index=True)["v"].rolling(n, min_periods=3, center=True)
    got = rolling(frame(spark, pdf), "v", n, ["t", "id"], max_group_rows=0, segment_rows=segment).toPandas()
    got = got.sort_values(["t", "id"], ignore_index=True)
    np.testing.assert_allclose(got["roll_mean"], want.mean(), atol=1e-9)
    np.testing.assert_allclose(got["roll_std"], want.std(), atol=1e-7)


@pytest.mark.parametrize("segment", [130, 400])
def test_smoothing_equals_the_recursion(spark, segment):
    pdf = hot_rows(7, 1000).fillna({"v": 0.5})
    got = OrderedFrame.of(spark.createDataFrame(pdf), ["k"], ["t", "id"], max_group_rows=0, segment_rows=segment)
    got = got.smooth("v", "s", 0.32, 4000.0).result().toPandas().set_index("id")["s"]
    for _, group in pdf.sort_values(["t", "id"]).groupby("k"):
        previous = 4000.0
        for row in group.itertuples():
            previous = 0.68 * previous + 0.32 * row.v
            assert got[row.id] == pytest.approx(previous, rel=1e-12, abs=1e-12)


def test_lags_are_one_window_and_gaps_cross_segments(spark):
    values = [None if i % 3 == 0 or 10 <= i % 40 < 24 else float(i) for i in range(200)]
    rows = [("ab"[i // 120], i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "area string, ts int, v double")
    names = {"lag1": 1, "lag3": 3}
    plain = lag_features(df, "area", ["ts"], "v", names)
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    want = {}
    for area, i, _ in rows:
        back = [[v for a, j, v in rows if a == area and j <= i - k and v is not None] for k in names.values()]
        want[i] = tuple(x[-1] if x else 0.0 for x in back)
    for sizes in ({}, {"max_group_rows": 0, "segment_rows": 7}, {"max_group_rows": 0, "segment_rows": 2}):
        got = lag_features(df, "area", ["ts"], "v", names, **sizes).collect()
        assert {r["ts"]: (r["lag1"], r["lag3"]) for r in got} == want and len(got) == 200
