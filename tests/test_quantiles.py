"""Exact quantiles and cuts against numpy, with the limits set low enough to take every path."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridpulse.operators.quantiles import chronological_split, exact_quantiles, last_rows, rank_cut

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("limit", [50, 10_000])
@pytest.mark.parametrize("kind", ["normal", "ties", "hot"])
def test_global_quantiles(spark, limit, kind):
    rng = np.random.default_rng(0)
    x = {"normal": rng.normal(size=3000), "ties": rng.integers(0, 5, 3000).astype(float),
         "hot": np.where(rng.random(3000) < 0.4, 7.0, rng.normal(size=3000))}[kind]
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": -x}))
    got = exact_quantiles(df, ["x", "y"], PROBS, max_group_rows=limit).first()
    np.testing.assert_allclose(got["x"], np.quantile(x, PROBS), atol=1e-12)
    np.testing.assert_allclose(got["y"], np.quantile(-x, PROBS), atol=1e-12)


def test_grouped_quantiles_mix_small_and_large_groups(spark):
    rng = np.random.default_rng(1)
    k = np.where(rng.random(2000) < 0.4, "hot", np.char.add("k", rng.integers(0, 30, 2000).astype(str)))
    pdf = pd.DataFrame({"k": k, "x": rng.normal(size=2000)})
    df = spark.createDataFrame(pdf)
    got = exact_quantiles(df, ["x"], PROBS, ["k"], max_group_rows=100).toPandas().set_index("k")["x"]
    assert len(got) == pdf["k"].nunique()
    for key, group in pdf.groupby("k"):
        np.testing.assert_allclose(got[key], np.quantile(group["x"], PROBS), atol=1e-12)


def test_nan_and_null_are_left_out(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,), (3.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).first()["x"] == [2.0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 6), min_size=5, max_size=60), st.floats(0.05, 0.95))
def test_split_sizes_and_order(spark, times, fraction):
    df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "t int, id int")
    train, test = chronological_split(df, ["t", "id"], fraction, max_group_rows=3)
    a, b = [sorted((r["t"], r["id"]) for r in part.collect()) for part in (train, test)]
    assert len(a) == int(len(times) * fraction)
    assert a + b == sorted((t, i) for i, t in enumerate(times))


def test_cut_inside_one_hot_time(spark):
    df = spark.range(1000).select(F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("t"), "id")
    assert rank_cut(df, ["t", "id"], 800, max_group_rows=10) == [dt.datetime(2024, 1, 1), 799]


@pytest.mark.parametrize("n", [1, 5, 40, 100])
def test_last_rows(spark, n):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * (i % 11)), i) for i in range(40)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, id int")
    got = [(r["t"], r["id"]) for r in last_rows(df, "t", ["id"], n).collect()]
    assert got == sorted(rows, reverse=True)[:n]
