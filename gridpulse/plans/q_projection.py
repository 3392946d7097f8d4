"""B-series: projections, filters, predicates, reshaping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions import features, predicates
from gridpulse.functions.constants import NAMED_DEFAULTS
from gridpulse.operators import cleaning, reshape
from gridpulse.plans.q_aggregates import NULL_TEXT
from gridpulse.plans.registry import query
from gridpulse.plans.views import Tables
from gridpulse.schemas import DATASETS


@query("b01_column_split", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{kind}' AS kind, count({c}) AS n_values FROM orders"
    for c, kind in (("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_totalprice", "numeric"),
                    ("o_orderstatus", "text"), ("o_orderpriority", "text"))))
def b01(t: Tables) -> DataFrame:
    df = t.orders
    numeric, text = predicates.split_columns(df)
    counts = df.agg(*[F.count(c).alias(c) for c in numeric + text])
    rows = cleaning.long_counts(counts, "column", "n_values")
    return rows.withColumn("kind", F.when(F.col("column").isin(numeric), "numeric").otherwise("text"))


@query("b02_drop_columns", "SELECT * EXCLUDE (o_orderpriority, o_custkey) FROM orders")
def b02(t: Tables) -> DataFrame:
    return t.orders.drop("o_orderpriority", "o_custkey", "not_there")


@query("b03_rename_columns", "SELECT event_id, value AS reading, user_id AS area FROM events")
def b03(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "value", "user_id")
    return rows.withColumnsRenamed({"value": "reading", "user_id": "area", "PM2.5": "PM2_5"})


@query("b04_parse_timestamp", """
    SELECT event_id, TRY_CAST(day_text AS TIMESTAMP) AS ts FROM dirty WHERE TRY_CAST(day_text AS TIMESTAMP) IS NOT NULL""")
def b04(t: Tables) -> DataFrame:
    parsed = cleaning.parse_time(t.dirty.select("event_id", "day_text"), "ts", "day_text")
    return parsed.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("b05_null_like", f"SELECT event_id, {NULL_TEXT.format(c='event_type')} AS missing FROM dirty")
def b05(t: Tables) -> DataFrame:
    return t.dirty.select("event_id", predicates.null_like("event_type").alias("missing"))


DEFAULTED = ", ".join(
    f"CASE WHEN {NULL_TEXT.format(c=c)} THEN '{d}' ELSE {c} END AS {c}" for c, d in NAMED_DEFAULTS.items())


@query("b06_named_defaults", f"SELECT order_no, part_no, supp_no, line_no, {DEFAULTED} FROM traffic")
def b06(t: Tables) -> DataFrame:
    keys = ["order_no", "part_no", "supp_no", "line_no"]
    return cleaning.named_defaults(t.traffic.select(*keys, *NAMED_DEFAULTS), NAMED_DEFAULTS)


RULES_SQL = {
    "b07_range_rules_traffic": ("traffic", {
        "vehicle_count_negative": "vehicle_count < 0",
        "avg_speed_out_of_range": "avg_speed < 0 OR avg_speed > 120",
        "signal_wait_out_of_range": "signal_wait_time < 0 OR signal_wait_time > 300"}),
    "b08_cross_rules_traffic": ("traffic", {
        "low_congestion_high_volume": "congestion_level = 'Low' AND vehicle_count > 800",
        "heavy_rain_high_speed": "weather = 'Heavy Rain' AND avg_speed > 60",
        "low_volume_long_wait": "vehicle_count < 100 AND signal_wait_time > 200"}),
    "b09_range_rules_energy": ("energy", {
        "consumption_negative": "energy_consumption < 0",
        "temperature_out_of_range": "temperature < -50 OR temperature > 60",
        "humidity_out_of_range": "humidity < 0 OR humidity > 100",
        "renewable_out_of_range": "renewable_usage < 0 OR renewable_usage > 100"}),
    "b10_cross_rules_energy": ("energy", {
        "high_demand_low_use": "demand_level = 'High' AND energy_consumption < 3000",
        "low_demand_high_use": "demand_level = 'Low' AND energy_consumption > 6500",
        "night_renewable": "hour IN (0, 1, 2, 3, 4, 5) AND renewable_usage > 20",
        "day_no_renewable": "hour BETWEEN 10 AND 16 AND renewable_usage < 1"}),
    "b11_range_rules_pollution": ("pollution", {
        **{f"{c.lower()}_negative": f'"{c}" < 0' for c in ("AQI", "PM2_5", "PM10", "NO2", "CO")},
        "temperature_too_low": "temperature < -50", "humidity_negative": "humidity < 0"}),
}
for _name, (_view, _rules) in RULES_SQL.items():
    query(_name, " UNION ALL ".join(
        f"SELECT '{r}' AS rule, CAST(count_if({cond}) AS BIGINT) AS n_rows FROM {_view}" for r, cond in _rules.items()))(
        lambda t, v=_view, names=tuple(_rules): cleaning.violations(
            getattr(t, v), {k: c for k, c in cleaning.rules(v).items() if k in names}))


@query("b12_view_filter", """
    SELECT reading_id, timestamp, area, zone, season, energy_consumption FROM energy
    WHERE zone IN ('East', 'South') AND season IN ('Summer', 'Winter') AND area IN ('Whitefield', 'Silk Board', 'Jayanagar')
        AND timestamp >= TIMESTAMP '1996-03-01' AND timestamp <= TIMESTAMP '1999-12-31 23:59:59'""")
def b12(t: Tables) -> DataFrame:
    rows = t.energy.select("reading_id", "timestamp", "area", "zone", "season", "energy_consumption")
    return reshape.apply_filters(rows, ["Whitefield", "Silk Board", "Jayanagar"], ["East", "South"],
                                 ["Summer", "Winter"], date(1996, 3, 1), date(1999, 12, 31))


@query("b12_view_filter_empty_choice", "SELECT event_id, value FROM events")
def b12_empty(t: Tables) -> DataFrame:
    return reshape.apply_filters(t.events.select("event_id", "value"))


@query("b13_time_bounds", """
    SELECT min(lo) AS min_ts, max(hi) AS max_ts FROM (
        SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM traffic
        UNION ALL SELECT min(timestamp), max(timestamp) FROM energy
        UNION ALL SELECT min(timestamp), max(timestamp) FROM pollution)""")
def b13(t: Tables) -> DataFrame:
    return reshape.time_bounds([t.traffic, t.energy, t.pollution])


@query("b14_required_columns", "SELECT area, count(*) AS n FROM energy GROUP BY area")
def b14(t: Tables) -> DataFrame:
    ready = cleaning.require_columns(t.energy, DATASETS["energy"].required)
    return ready.groupBy("area").agg(F.count("*").alias("n"))


@query("b15_add_if_absent", """
    SELECT reading_id, hour, temperature, temperature * temperature AS temp_squared FROM energy""")
def b15(t: Tables) -> DataFrame:
    rows = t.energy.select("reading_id", "hour", "temperature")
    return features.add_missing(rows, {
        "hour": F.lit(-1), "temp_squared": F.col("temperature") * F.col("temperature")})


@query("b16_empty_batch_guard", """
    SELECT 'all' AS batch, count(*) AS n FROM events""")
def b16(t: Tables) -> DataFrame:
    batches = {"none": t.events.filter("value < 0"), "all": t.events}
    kept = [df.agg(F.lit(name).alias("batch"), F.count("*").alias("n"))
            for name, df in batches.items() if not df.isEmpty()]
    return reshape.merge_batches(kept)


PREDICTED = "CASE WHEN zone = 'East' THEN energy_consumption * 0.9::DOUBLE END AS predicted"


@query("b17_rows_with_prediction", f"""
    SELECT reading_id, predicted FROM (SELECT reading_id, zone, {PREDICTED} FROM energy) WHERE predicted IS NOT NULL""",
    rounded="predicted")
def b17(t: Tables) -> DataFrame:
    predicted = F.when(F.col("zone") == "East", F.col("energy_consumption") * 0.9)
    raw = t.energy.select("reading_id", "zone", predicted.alias("predicted"))
    # the filter leaves no predicted row, so the unfiltered ones are used
    return reshape.with_prediction(raw.filter("zone = 'West'"), raw, "predicted").drop("zone")


@query("b18_fixed_sample", """
    SELECT event_id, value FROM events ORDER BY md5(CAST(event_id AS VARCHAR) || ':42'), event_id LIMIT 500""")
def b18(t: Tables) -> DataFrame:
    return reshape.fixed_sample(t.events.select("event_id", "value"), "event_id", 500, 42, "md5")


@query("b19_melt", """
    SELECT reading_id, 'PM2_5' AS pollutant, "PM2_5" AS level FROM pollution
    UNION ALL SELECT reading_id, 'PM10', "PM10" FROM pollution""", rounded="level")
def b19(t: Tables) -> DataFrame:
    rows = t.pollution.select("reading_id", "PM2_5", "PM10")
    return reshape.melt(rows, ["reading_id"], ["PM2_5", "PM10"], "pollutant", "level")


@query("b21_inspect", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def b21(t: Tables) -> DataFrame:
    return t.orders.orderBy("o_orderkey").limit(5)
