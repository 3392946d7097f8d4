"""The detector against a row-by-row restatement of its rules, and its limits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridpulse.operators import anomaly, kpi, stats


def brute(values: list[float | None], k=2.0, window=24, limit=2.5):
    """Rules stated per row in plain Python, for a short series."""
    n = len(values)
    known = np.array([v for v in values if v is not None], dtype=float)
    if n < 5 or not len(known):
        return [(0.0, False, False, False, "")] * n
    mu, sd = known.mean(), known.std(ddof=1)
    q1, q3 = np.quantile(known, [0.25, 0.75])
    out = []
    for i, v in enumerate(values):
        if v is None:
            out.append((None, False, False, False, ""))
            continue
        z = abs((v - mu) / sd) if sd > 0 else 0.0
        near = [x for x in values[max(0, i - 12): i + 12] if x is not None]
        spread = np.std(near, ddof=1) if len(near) >= 3 else 0.0
        spread = sd if spread == 0 else spread
        rolling = len(near) >= 3 and abs(v - np.mean(near)) > limit * spread
        iqr = v < q1 - k * (q3 - q1) or v > q3 + k * (q3 - q1)
        hit = z > 3 or iqr or rolling
        out.append((z, z > 3, bool(iqr), bool(rolling), "" if not hit else "HIGH" if z > 4 else "MEDIUM" if z > 3 else "LOW"))
    return out


def run(spark, values, **kw):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "t int, v double")
    got = anomaly.detect_anomalies(df, "v", ["t"], **kw).orderBy("t").collect()
    return [(r["anomaly_zscore_val"], r["anomaly_zscore"], r["anomaly_iqr"], r["anomaly_rolling"], r["anomaly_severity"]) for r in got]


@pytest.mark.parametrize("sizes", [{}, {"max_group_rows": 0, "segment_rows": 30}])
def test_detector_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(3)
    values = [float(v) for v in rng.normal(100, 10, 300)]
    for i in range(0, 300, 37):
        values[i] *= 1 + i / 150
    values[10] = values[200] = None
    got, want = run(spark, values, **sizes), brute(values)
    assert [g[1:] for g in got] == [w[1:] for w in want]
    assert {g[4] for g in got} >= {"", "HIGH", "LOW"}


@pytest.mark.parametrize("values", [[], [1.0], [1.0, 1.0, 1.0, 900.0], [5.0] * 30, [None] * 8])
def test_no_flags_without_enough_spread_or_rows(spark, values):
    assert all(not any(g[1:4]) and g[4] == "" for g in run(spark, values))


def test_nan_counts_as_missing(spark):
    assert [g[1:] for g in run(spark, [float("nan")] + [1.0, 2.0, 3.0] * 4)][0] == (False, False, False, "")


def test_summary_without_anomalies(spark):
    df = spark.createDataFrame([("a", 5.0, i) for i in range(10)], "area string, v double, t int")
    row = anomaly.summary(anomaly.detect_anomalies(df, "v", ["t"]), "v", "x").first()
    assert (row["total"], row["n_anom"], row["pct"], row["worst"], row["worst_area"]) == (10, 0, 0.0, None, None)


def test_recent_change_limits(spark):
    df = spark.createDataFrame([(i, 10.0 if i < 8 else 15.0) for i in range(10)], "t int, v double")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("t") * 86400))
    assert kpi.recent_change(df, "v", "ts", ["t"], 2).first()["delta_pct"] == 50.0
    assert kpi.recent_change(df, "v", "ts", ["t"], 6).first()["delta_pct"] is None
    zero = df.withColumn("v", F.lit(0.0))
    assert kpi.recent_change(zero, "v", "ts", ["t"], 2).first()["delta_pct"] is None


def test_city_score_stays_between_0_and_100(spark):
    traffic = spark.createDataFrame([(9000.0, "High", "Accident")] * 3, "vehicle_count double, congestion_level string, incident string")
    energy = spark.createDataFrame([(99999.0, 1, 0.0)] * 3, "energy_consumption double, power_outage int, renewable_usage double")
    pollution = spark.createDataFrame(pd.DataFrame({"AQI": [900.0, 901.0]}))
    row = kpi.city_score(traffic, energy, pollution).first()
    assert row["traffic_score"] == 0.0 and row["energy_score"] == 0.0 and row["pollution_score"] == 0.0
    assert 0.0 <= row["city_score"] <= 100.0 and row["grade"] == "Poor"


def test_nan_counts_as_missing_in_headline_numbers(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(1, 1.0, 2.0), (2, nan, 5.0), (3, 3.0, 6.0), (4, None, nan)], "t int, v double, w double")
    rows = rows.withColumn("ts", F.timestamp_seconds(F.col("t") * 86400)).withColumn("k", F.lit("a"))
    got = {r["metric"]: r["delta_pct"] for r in kpi.recent_changes(rows, ["v", "w"], "ts", ["t"], 2).collect()}
    assert got == {"v": 200.0, "w": round((6.0 - 3.5) / 3.5 * 100, 1)}
    assert stats.mean_std(rows, "k", "v").first()["mean"] == 2.0
    ci = stats.mean_ci(rows, "k", "v").first()
    assert (ci["n"], ci["mean"]) == (2, 2.0)
    assert stats.pivot_mean(rows, "k", "k", ["a"], "v").first()[1] == 2.0
    pairs = {(r["x"], r["y"]): r["corr"] for r in stats.correlations(rows, ["v", "w"]).collect()}
    assert pairs["v", "w"] == 1.0
    assert stats.linear_trend(rows, "v", "w").first()["slope"] == 2.0
    pollution = rows.withColumnRenamed("v", "AQI")
    assert kpi._domains(
        rows.select(F.col("v").alias("vehicle_count"), F.lit("High").alias("congestion_level"), F.lit("No Incident").alias("incident")),
        rows.select(F.col("v").alias("energy_consumption"), F.lit(0).alias("power_outage"), F.lit(1.0).alias("renewable_usage")),
        pollution).select("p.mean").first()[0] == 2.0


def test_many_metrics_read_the_table_twice_and_city_kpis_each_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(
        F.col("id").alias("t"), F.timestamp_seconds(F.col("id") * 40000).alias("ts"), F.rand(1).alias("a"), F.rand(2).alias("b")).write.parquet(path)

    def scans(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return sum("Relation" in line for line in plan.splitlines())

    changes = kpi.recent_changes(spark.read.parquet(path), ["a", "b"], "ts", ["t"], 10)
    assert changes.count() == 2 and scans(changes) <= 2  # the sums per day, and the last days of the table
    table = spark.read.parquet(path)
    city = kpi.city_kpis(
        table.select(F.col("a").alias("vehicle_count"), F.col("b").alias("avg_speed"), F.lit("Low").alias("congestion_level"), F.lit("x").alias("incident")),
        table.select(F.col("a").alias("energy_consumption"), F.lit(0).alias("power_outage"), F.col("b").alias("renewable_usage")),
        table.select(F.col("a").alias("AQI")))
    assert city.count() == 1 and scans(city) <= 3


def test_density_with_a_large_offset(spark):
    near = spark.range(200).select((F.col("id") % 18 / 10.0).alias("v"))  # no value on an inner bin edge
    far = near.select((F.col("v") + 1e9).alias("v"))
    a, b = (stats.density_curve(d, "v").orderBy("point").toPandas()["density"].to_numpy() for d in (near, far))
    assert abs(a - b).max() < 1e-4
