"""Cleaning on hand-written edge frames."""

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import cleaning
from gridpulse.operators.reshape import merge_batches, select_once

NAN = float("nan")


def pairs(df, key):
    return {r[key]: r for r in df.collect()}


def test_nothing_is_missing_after_imputation(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, " None "), (None, "N/A"), (4.0, "a"), (7.0, "b"), (0.0, None)], "x double, s string")
    assert {r["column"]: r["n_missing"] for r in cleaning.missing_profile(df).collect()} == {"x": 2, "s": 3}
    done = cleaning.impute(df)
    assert all(r["n_missing"] == 0 for r in cleaning.missing_profile(done).collect())
    assert sorted(r["x"] for r in done.collect()) == [0.0, 1.0, 3.0, 3.0, 4.0, 7.0]
    assert [r["s"] for r in done.collect()].count("a") == 5


def test_mode_tie_goes_to_the_smaller_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "s string")
    assert cleaning.modes(df, ["s"]).first()["mode"] == "a"


def test_all_null_columns_stay_null(spark):
    df = spark.createDataFrame([(None, None), (None, "")], "x double, s string")
    got = cleaning.impute(df).collect()
    assert [r["x"] for r in got] == [None, None]
    assert [r["s"] for r in got] == [None, ""]


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, s string")
    assert cleaning.duplicate_count(df).first().asDict() == {"n_rows": 0, "n_distinct": 0, "n_duplicates": 0}
    assert cleaning.impute(df).count() == 0
    bounds = cleaning.iqr_bounds(df, ["x"])
    assert cleaning.outlier_counts(df, bounds).first()["n_outliers"] == 0
    assert cleaning.cap_outliers(df, bounds).count() == 0


def test_constant_column_and_capping_twice(spark):
    df = spark.createDataFrame([(5.0,)] * 10 + [(500.0,), (None,)], "x double")
    bounds = cleaning.iqr_bounds(df, ["x"], exact=True)
    assert cleaning.outlier_counts(df, bounds).first()["n_outliers"] == 1
    once = cleaning.cap_outliers(df, bounds)
    assert sorted((r["x"] for r in once.collect()), key=lambda v: (v is None, v)) == [5.0] * 11 + [None]
    twice = cleaning.cap_outliers(once, bounds)
    assert once.exceptAll(twice).count() == 0
    assert cleaning.outlier_counts(once, bounds).first()["n_outliers"] == 0


def test_second_deduplication_finds_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "b")], "i int, s string")
    assert cleaning.duplicate_count(df).first()["n_duplicates"] == 2
    assert cleaning.duplicate_count(cleaning.drop_duplicates(df)).first()["n_duplicates"] == 0


def test_unparsable_times_are_dropped_and_raise_nothing(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("junk",), (None,)], "timestamp string")
    assert cleaning.parse_time(df, "timestamp").count() == 1


def test_required_columns_fail_before_any_job(spark):
    with pytest.raises(ValueError, match="area, hour"):
        cleaning.require_columns(spark.range(1), ["id", "area", "hour"])


def test_unknown_dataset_has_no_rules():
    with pytest.raises(ValueError):
        cleaning.rules("noise")


def test_union_of_nothing_and_repeated_names(spark):
    assert merge_batches([]) is None
    both = spark.range(2).join(spark.range(2).withColumn("ID2", F.lit(1)), on=[F.lit(True)], how="left")
    assert select_once(both).columns == ["id", "ID2"]
