"""E-series: lags, fills, splits, rolling windows, anomaly detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.operators import anomaly, ordered, quantiles
from gridpulse.plans.registry import query
from gridpulse.plans.views import Tables

# The registered windows over the whole table always take the segmented path,
# so that the SQL check covers what runs on hot keys and large tables.
SEGMENTS = {"max_group_rows": 0, "segment_rows": 2_000}
ORDER = ["ts", "event_id"]

DETECT_SQL = """
    scored AS (
        SELECT e.*, s.n, s.mu, s.sigma, s.q1 - 2 * (s.q3 - s.q1) AS lo, s.q3 + 2 * (s.q3 - s.q1) AS hi,
            CASE WHEN count(e.value) OVER w >= 3 THEN avg(e.value) OVER w END AS rm,
            CASE WHEN count(e.value) OVER w >= 3 THEN stddev_samp(e.value) OVER w END AS rs
        FROM spiked e, (SELECT count(*) AS n, avg(value) AS mu, stddev_samp(value) AS sigma,
                quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM spiked) s
        WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)
    ),
    flagged AS (
        SELECT event_id, user_id, ts, event_type, value,
            CASE WHEN n >= 5 AND sigma > 0 THEN abs((value - mu) / sigma) ELSE 0 END AS anomaly_zscore_val,
            n >= 5 AND (value < lo OR value > hi) AS anomaly_iqr,
            n >= 5 AND coalesce(abs(value - rm) > 2.5 * coalesce(CASE WHEN rs <> 0 THEN rs END, sigma), false)
                AS anomaly_rolling
        FROM scored
    ),
    detected AS (
        SELECT *, anomaly_zscore_val > 3 AS anomaly_zscore,
            (anomaly_zscore_val > 3 OR anomaly_iqr OR anomaly_rolling) AS is_anomaly,
            CASE WHEN NOT (anomaly_zscore_val > 3 OR anomaly_iqr OR anomaly_rolling) THEN ''
                 WHEN anomaly_zscore_val > 4 THEN 'HIGH' WHEN anomaly_zscore_val > 3 THEN 'MEDIUM'
                 ELSE 'LOW' END AS anomaly_severity
        FROM flagged
    )
"""
SPIKED_SQL = """
    spiked AS (SELECT event_id, user_id, ts, event_type,
        CASE WHEN event_id % 101 = 0 THEN value * 20 ELSE value END AS value FROM events)
"""


def detected_sql(select: str) -> str:
    return f"SELECT * FROM (WITH {SPIKED_SQL}, {DETECT_SQL} {select})"


def spiked(t: Tables) -> DataFrame:
    value = F.when(F.col("event_id") % 101 == 0, F.col("value") * 20).otherwise(F.col("value"))
    return t.events.select("event_id", "user_id", "ts", "event_type", value.alias("value"))


def detected(t: Tables) -> DataFrame:
    return anomaly.detect_anomalies(spiked(t), "value", ORDER, **SEGMENTS)


@query("e01_lag_by_key", """
    SELECT event_id, user_id, ts, value, lag(value, 1) OVER w AS lag1, lag(value, 2) OVER w AS lag2
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def e01(t: Tables) -> DataFrame:
    frame = ordered.OrderedFrame.of(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ORDER)
    lags = {f"lag{k}": (lambda w, k=k: F.lag("value", k).over(w)) for k in (1, 2)}
    return frame.windows(lags, 2, 0).result()


@query("e01_lag_split_keys", """
    SELECT event_id, event_type, ts, value, lag(value, 1) OVER w AS lag1, lag(value, 2) OVER w AS lag2
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def e01_split(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "ts", "value")
    frame = ordered.OrderedFrame.of(rows, ["event_type"], ORDER, **SEGMENTS)
    lags = {f"lag{k}": (lambda w, k=k: F.lag("value", k).over(w)) for k in (1, 2)}
    return frame.windows(lags, 2, 0).result()


FILL_SQL = """
    SELECT * FROM (WITH l AS (
        SELECT event_id, {key}, ts, value, lag(value, 1) OVER w AS lag1, lag(value, 2) OVER w AS lag2
        FROM (SELECT event_id, user_id, event_type, ts, CASE WHEN event_id % 5 < 3 THEN NULL ELSE value END AS value
              FROM events) WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id))
    SELECT event_id, {key}, ts, value,
        coalesce(last_value(lag1 IGNORE NULLS) OVER w, 0) AS lag1,
        coalesce(last_value(lag2 IGNORE NULLS) OVER w, 0) AS lag2
    FROM l WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def gappy(t: Tables, key: str) -> DataFrame:
    value = F.when(F.col("event_id") % 5 < 3, F.lit(None).cast("double")).otherwise(F.col("value"))
    return t.events.select("event_id", key, "ts", value.alias("value"))


@query("e02_lag_forward_fill", FILL_SQL.format(key="user_id"))
def e02(t: Tables) -> DataFrame:
    return ordered.lag_features(gappy(t, "user_id"), "user_id", ORDER, "value", {"lag1": 1, "lag2": 2})


@query("e02_forward_fill_split_keys", FILL_SQL.format(key="event_type"))
def e02_split(t: Tables) -> DataFrame:
    return ordered.lag_features(
        gappy(t, "event_type"), "event_type", ORDER, "value", {"lag1": 1, "lag2": 2}, **SEGMENTS)


@query("e03_global_row_number", """
    SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS row_num FROM events""")
def e03(t: Tables) -> DataFrame:
    return ordered.row_numbers(t.events.select("event_id", "ts"), ORDER)


@query("e03_row_number_hot_time", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, date_trunc('year', l_shipdate)::TIMESTAMP AS y,
        row_number() OVER (ORDER BY date_trunc('year', l_shipdate), l_orderkey, l_partkey, l_suppkey, l_linenumber)
            AS row_num
    FROM lineitem""")
def e03_hot(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    rows = t.lineitem.select(*keys, F.date_trunc("year", "l_shipdate").cast("timestamp_ntz").alias("y"))
    return ordered.row_numbers(rows, ["y", *keys])


@query("e04_chronological_split", """
    SELECT event_id, ts, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part
    FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS n FROM events)""")
def e04(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "ts")
    train, test = quantiles.chronological_split(rows, ORDER, 0.8)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("e04_split_hot_time", """
    SELECT part, count(*) AS n, min(rn) AS first_rn, max(rn) AS last_rn FROM (
        SELECT rn, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM (
            SELECT row_number() OVER (ORDER BY date_trunc('year', l_shipdate), l_orderkey, l_partkey, l_suppkey,
                l_linenumber) AS rn, count(*) OVER () AS n FROM lineitem)) GROUP BY part""")
def e04_hot(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    order = ["y", *keys]
    rows = t.lineitem.select(*keys, F.date_trunc("year", "l_shipdate").cast("timestamp_ntz").alias("y"))
    numbered = ordered.row_numbers(rows, order, "rn")
    train, test = quantiles.chronological_split(rows, order, 0.8, max_group_rows=1_000)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    joined = both.join(numbered, order)
    return joined.groupBy("part").agg(F.count("*").alias("n"), F.min("rn").alias("first_rn"), F.max("rn").alias("last_rn"))


@query("e05_centred_rolling", """
    SELECT event_id, ts, value,
        CASE WHEN count(value) OVER w >= 3 THEN avg(value) OVER w END AS roll_mean,
        CASE WHEN count(value) OVER w >= 3 THEN stddev_samp(value) OVER w END AS roll_std
    FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)""",
    rounded="roll_mean roll_std")
def e05(t: Tables) -> DataFrame:
    return ordered.rolling(t.events.select("event_id", "ts", "value"), "value", 24, ORDER, **SEGMENTS)


@query("e05_centred_rolling_by_key", """
    SELECT event_id, user_id, ts, value,
        CASE WHEN count(value) OVER w >= 3 THEN avg(value) OVER w END AS roll_mean,
        CASE WHEN count(value) OVER w >= 3 THEN stddev_samp(value) OVER w END AS roll_std
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
    rounded="roll_mean roll_std")
def e05_by_key(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return ordered.rolling(rows, "value", 7, ORDER, ["user_id"])


@query("e06_trailing_hourly_mean", """
    SELECT hour, mean_value, avg(mean_value) OVER (ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS trailing
    FROM (SELECT CAST(hour(ts) AS INT) AS hour, avg(value) AS mean_value FROM events GROUP BY 1)""",
    rounded="mean_value trailing")
def e06(t: Tables) -> DataFrame:
    hourly = t.events.groupBy(F.hour("ts").alias("hour")).agg(F.avg("value").alias("mean_value"))
    frame = Window.orderBy("hour").rowsBetween(-2, 0)  # 24 rows
    return hourly.withColumn("trailing", F.avg("mean_value").over(frame))


@query("e07_trailing_anomaly_rate", detected_sql("""
    SELECT event_id, ts, is_anomaly, CASE WHEN count(*) OVER w >= 10 THEN avg(CAST(is_anomaly AS INT)) OVER w * 100 END
        AS anomaly_rate FROM detected WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)"""),
    rounded="anomaly_rate")
def e07(t: Tables) -> DataFrame:
    rows = detected(t).select("event_id", "ts", "is_anomaly")
    return anomaly.anomaly_rate(rows, ORDER, **SEGMENTS)


@query("e08_global_zscore", """
    SELECT event_id, value, abs((value - mu) / sigma) AS zscore
    FROM events, (SELECT avg(value) AS mu, stddev_samp(value) AS sigma FROM events)""", rounded="zscore")
def e08(t: Tables) -> DataFrame:
    return anomaly.z_scores(t.events.select("event_id", "value"), "value")


@query("e09_detect_anomalies", detected_sql("SELECT * FROM detected"), rounded="anomaly_zscore_val")
def e09(t: Tables) -> DataFrame:
    return detected(t)


@query("e09_detect_by_key", """
    SELECT * FROM (WITH s AS (SELECT event_type, count(*) AS n, avg(value) AS mu, stddev_samp(value) AS sigma,
            quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),
    r AS (SELECT e.event_id, e.event_type, e.ts, e.value, s.*  EXCLUDE (event_type),
            CASE WHEN count(e.value) OVER w >= 3 THEN avg(e.value) OVER w END AS rm,
            CASE WHEN count(e.value) OVER w >= 3 THEN stddev_samp(e.value) OVER w END AS rs
          FROM events e JOIN s USING (event_type)
          WINDOW w AS (PARTITION BY e.event_type ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)),
    f AS (SELECT event_id, event_type, ts, value, abs((value - mu) / sigma) AS anomaly_zscore_val,
            (value < q1 - 2 * (q3 - q1) OR value > q3 + 2 * (q3 - q1)) AS anomaly_iqr,
            coalesce(abs(value - rm) > 2.5 * coalesce(CASE WHEN rs <> 0 THEN rs END, sigma), false) AS anomaly_rolling
          FROM r)
    SELECT *, anomaly_zscore_val > 3 AS anomaly_zscore,
        (anomaly_zscore_val > 3 OR anomaly_iqr OR anomaly_rolling) AS is_anomaly,
        CASE WHEN NOT (anomaly_zscore_val > 3 OR anomaly_iqr OR anomaly_rolling) THEN ''
             WHEN anomaly_zscore_val > 4 THEN 'HIGH' WHEN anomaly_zscore_val > 3 THEN 'MEDIUM' ELSE 'LOW' END
            AS anomaly_severity FROM f)""", rounded="anomaly_zscore_val")
def e09_by_key(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "ts", "value")
    return anomaly.detect_anomalies(rows, "value", ORDER, ["event_type"], **SEGMENTS)


@query("e09_detect_severity", detected_sql("""
    SELECT anomaly_severity, count(*) AS n, max(anomaly_zscore_val) AS max_z FROM detected
    GROUP BY anomaly_severity"""), rounded="max_z")
def e09_severity(t: Tables) -> DataFrame:
    return detected(t).groupBy("anomaly_severity").agg(
        F.count("*").alias("n"), F.max("anomaly_zscore_val").alias("max_z"))


@query("e10_control_band", """
    SELECT avg(value) AS centre, avg(value) - 3 * stddev_samp(value) AS "lower",
        avg(value) + 3 * stddev_samp(value) AS "upper" FROM events""", rounded="centre lower upper")
def e10(t: Tables) -> DataFrame:
    return anomaly.control_band(t.events, "value")


def named(t: Tables) -> DataFrame:
    return detected(t).withColumnRenamed("event_type", "area")


@query("d33_anomaly_summary", detected_sql("""
    SELECT 'events' AS label, count(*) AS total, CAST(count_if(is_anomaly) AS BIGINT) AS n_anom,
        round(count_if(is_anomaly) / count(*) * 100, 1) AS pct,
        CAST(count_if(anomaly_severity = 'HIGH') AS BIGINT) AS high,
        CAST(count_if(anomaly_severity = 'MEDIUM') AS BIGINT) AS medium,
        CAST(count_if(anomaly_severity = 'LOW') AS BIGINT) AS low,
        max(value) FILTER (WHERE is_anomaly) AS worst,
        (SELECT event_type FROM detected WHERE is_anomaly GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS worst_area
    FROM detected"""))
def d33(t: Tables) -> DataFrame:
    return anomaly.summary(named(t), "value", "events")


@query("d34_anomalies_by_area_severity", detected_sql("""
    SELECT user_id, anomaly_severity, count(*) AS n FROM detected WHERE is_anomaly AND user_id IN (
        SELECT user_id FROM detected WHERE is_anomaly GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 15)
    GROUP BY 1, 2"""))
def d34(t: Tables) -> DataFrame:
    return anomaly.by_area_and_severity(detected(t), "user_id", 15)


@query("d35_flags_per_method", detected_sql("""
    SELECT 'zscore' AS method, CAST(count_if(anomaly_zscore) AS BIGINT) AS n FROM detected
    UNION ALL SELECT 'iqr', CAST(count_if(anomaly_iqr) AS BIGINT) FROM detected
    UNION ALL SELECT 'rolling', CAST(count_if(anomaly_rolling) AS BIGINT) FROM detected"""))
def d35(t: Tables) -> DataFrame:
    return anomaly.by_method(detected(t))


@query("d36_method_overlap", detected_sql("""
    SELECT CAST(anomaly_zscore AS INT) + CAST(anomaly_iqr AS INT) + CAST(anomaly_rolling AS INT) AS n_methods,
        count(*) AS n FROM detected WHERE is_anomaly GROUP BY 1"""))
def d36(t: Tables) -> DataFrame:
    return anomaly.method_overlap(detected(t))


@query("f08_anomaly_log", detected_sql("""
    SELECT ts, event_id, event_type, value AS "value (units)", anomaly_severity AS "Severity",
        round(anomaly_zscore_val, 2) AS "Z-Score", anomaly_zscore AS "By Z-Score", anomaly_iqr AS "By IQR",
        anomaly_rolling AS "By Rolling" FROM detected WHERE is_anomaly"""))
def f08(t: Tables) -> DataFrame:
    return anomaly.anomaly_log(detected(t), ["ts", "event_id", "event_type"], "value", "units")
