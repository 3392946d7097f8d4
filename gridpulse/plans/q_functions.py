"""H-series: scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from gridpulse.functions import bands, calendar, features
from gridpulse.functions import constants as K
from gridpulse.operators import kpi
from gridpulse.plans.registry import query
from gridpulse.plans.views import Tables
from gridpulse.sources import messages

HUB_LIST = ", ".join(f"'{a}'" for a in K.IT_HUB_AREAS)
INDUSTRY_LIST = ", ".join(f"'{a}'" for a in K.INDUSTRIAL_AREAS)
LEISURE_LIST = ", ".join(f"'{a}'" for a in K.LEISURE_AREAS)
CAPACITY_SQL = "CASE road_type WHEN 'Highway' THEN 1200::DOUBLE WHEN 'Street' THEN 350::DOUBLE ELSE 750::DOUBLE END"
FREE_SQL = "CASE road_type WHEN 'Highway' THEN 80::DOUBLE WHEN 'Street' THEN 35::DOUBLE ELSE 55::DOUBLE END"


def peak_sql(dataset: str) -> str:
    tests = " OR ".join(f"hour BETWEEN {a} AND {b}" for a, b in calendar.PEAK_HOURS[dataset])
    return f"CASE WHEN {tests} THEN 1 ELSE 0 END"


@query("h01_calendar_parts", """
    SELECT event_id, CAST(hour(ts) AS INT) AS hour, CAST(day(ts) AS INT) AS day, CAST(isodow(ts) - 1 AS INT) AS dayofweek,
        CAST(month(ts) AS INT) AS month, CAST(year(ts) AS INT) AS year FROM events""")
def h01(t: Tables) -> DataFrame:
    return calendar.with_calendar(t.events.select("event_id", "ts"), "ts").drop("ts")


@query("h02_season", """
    SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (3,4,5) THEN 'Summer'
        WHEN month(o_orderdate) IN (6,7,8,9) THEN 'Monsoon' ELSE 'Winter' END AS season FROM orders""")
def h02(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", calendar.season(F.month("o_orderdate")).alias("season"))


@query("h03_labels", """
    SELECT reading_id, CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS weekend_flag,
        CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
        CASE WHEN is_it_hub = 1 THEN 'IT Hub' ELSE 'Non-Hub' END AS hub,
        CASE WHEN power_outage = 1 THEN 'Outage' ELSE 'Normal' END AS outage,
        strftime(timestamp, '%a') AS day_name FROM energy""")
def h03(t: Tables) -> DataFrame:
    return t.energy.select(
        "reading_id",
        calendar.is_weekend(F.col("timestamp")).alias("weekend_flag"),
        calendar.day_type(F.col("is_weekend")).alias("day_type"),
        calendar.hub_label(F.col("is_it_hub")).alias("hub"),
        calendar.outage_label(F.col("power_outage")).alias("outage"),
        calendar.day_name(F.col("timestamp")).alias("day_name"))


@query("h04_peak_hours", f"""
    SELECT reading_id, hour, {peak_sql('traffic')} AS traffic_peak, {peak_sql('energy')} AS energy_peak,
        {peak_sql('pollution')} AS pollution_peak FROM pollution""")
def h04(t: Tables) -> DataFrame:
    return t.pollution.select("reading_id", "hour", *[
        calendar.peak_flag(F.col("hour"), d).alias(f"{d}_peak") for d in calendar.PEAK_HOURS])


@query("h05_road_lookup", f"""
    SELECT road_type, {CAPACITY_SQL} AS capacity, {FREE_SQL} AS free_flow, count(*) AS n FROM traffic GROUP BY 1, 2, 3""")
def h05(t: Tables) -> DataFrame:
    road = F.col("road_type")
    return t.traffic.groupBy(
        "road_type", bands.road_capacity(road).alias("capacity"), bands.free_flow_speed(road).alias("free_flow")
    ).agg(F.count("*").alias("n"))


TRAFFIC_KEYS = ["order_no", "part_no", "supp_no", "line_no"]


@query("h06_traffic_features", f"""
    SELECT order_no, part_no, supp_no, line_no, {peak_sql('traffic')} AS is_peak_hour, {CAPACITY_SQL} AS road_capacity,
        avg_speed / ({CAPACITY_SQL}) AS speed_to_capacity_ratio, avg_speed * ({peak_sql('traffic')}) AS speed_x_peak,
        hour * ({CAPACITY_SQL}) AS hour_x_capacity FROM traffic""",
    rounded="speed_to_capacity_ratio speed_x_peak", digits=9)
def h06(t: Tables) -> DataFrame:
    rows = t.traffic.select(*TRAFFIC_KEYS, "hour", "road_type", "avg_speed")
    return features.traffic_features(rows).drop("hour", "road_type", "avg_speed")


@query("h07_discomfort_index", """
    SELECT reading_id, temperature - 0.55::DOUBLE * (1 - humidity / 100) * (temperature - 14.5::DOUBLE) AS discomfort
    FROM energy""", rounded="discomfort")
def h07(t: Tables) -> DataFrame:
    index = features.discomfort_index(F.col("temperature"), F.col("humidity"))
    return t.energy.select("reading_id", index.alias("discomfort"))


@query("h08_h09_energy_features", f"""
    SELECT reading_id, {peak_sql('energy')} AS is_peak_hour,
        temperature - 0.55::DOUBLE * (1 - humidity / 100) * (temperature - 14.5::DOUBLE) AS temp_humidity_discomfort,
        CAST(temperature > 30 AS INT) AS high_temp_flag, CAST(temperature > 34 AS INT) AS very_high_temp,
        CAST(temperature < 18 AS INT) AS is_extreme_cold, temperature * temperature AS temp_squared,
        temperature * humidity AS temp_humidity_interaction, ({peak_sql('energy')}) * temperature AS peak_temp_interaction
    FROM energy""", rounded="temp_humidity_discomfort")
def h08(t: Tables) -> DataFrame:
    rows = t.energy.select("reading_id", "hour", "temperature", "humidity")
    return features.energy_features(rows).drop("hour", "temperature", "humidity")


@query("h09_h10_pollution_features", f"""
    SELECT reading_id, temperature * humidity AS temp_humidity_interaction,
        CASE WHEN humidity + 1 <> 0 THEN temperature / (humidity + 1) END AS temp_inversion_risk,
        {peak_sql('pollution')} AS peak_hour, CAST(humidity < 45 AS INT) AS low_humidity_flag FROM pollution""",
    rounded="temp_inversion_risk", digits=9)
def h10(t: Tables) -> DataFrame:
    rows = t.pollution.select("reading_id", "hour", "temperature", "humidity")
    return features.pollution_features(rows).drop("hour", "temperature", "humidity")


@query("h11_congestion_band", f"""
    SELECT order_no, part_no, supp_no, line_no, CASE WHEN vehicle_count / ({CAPACITY_SQL}) < 0.5 THEN 'Low'
        WHEN vehicle_count / ({CAPACITY_SQL}) < 0.85 THEN 'Medium' ELSE 'High' END AS band FROM traffic""")
def h11(t: Tables) -> DataFrame:
    load = F.col("vehicle_count") / bands.road_capacity(F.col("road_type"))
    return t.traffic.select(*TRAFFIC_KEYS, bands.congestion_band(load).alias("band"))


@query("h12_flow_speed_and_wait", f"""
    SELECT order_no, part_no, supp_no, line_no, greatest(4::DOUBLE, ({FREE_SQL}) / (1 + 0.15::DOUBLE *
        pow(vehicle_count / ({CAPACITY_SQL}), 4))) AS speed,
        CAST(least(300, floor(vehicle_count / 5)) AS BIGINT) AS wait FROM traffic""", rounded="speed")
def h12(t: Tables) -> DataFrame:
    v, road = F.col("vehicle_count"), F.col("road_type")
    speed = bands.flow_speed(v, bands.road_capacity(road), bands.free_flow_speed(road))
    return t.traffic.select(*TRAFFIC_KEYS, speed.alias("speed"), bands.signal_wait(v).alias("wait"))


@query("h13_demand_and_load", f"""
    SELECT reading_id, CASE WHEN energy_consumption > 6500 THEN 'High' WHEN energy_consumption > 3000 THEN 'Medium'
        ELSE 'Low' END AS demand, CASE WHEN area IN ({INDUSTRY_LIST}) THEN 'Industrial'
        WHEN area IN ({HUB_LIST}) OR zone = 'Central' THEN 'Commercial' ELSE 'Residential' END AS load FROM energy""")
def h13(t: Tables) -> DataFrame:
    return t.energy.select(
        "reading_id", bands.demand_band(F.col("energy_consumption")).alias("demand"),
        bands.load_type(F.col("area"), F.col("zone")).alias("load"))


@query("h14_aqi_band_and_alert", """
    SELECT reading_id, CASE WHEN "AQI" <= 50 THEN 'Good' WHEN "AQI" <= 100 THEN 'Moderate'
        WHEN "AQI" <= 150 THEN 'Unhealthy (Sensitive)' WHEN "AQI" <= 200 THEN 'Unhealthy' ELSE 'Hazardous' END AS band,
        CASE WHEN "AQI" > 200 THEN 'danger' WHEN "AQI" > 100 THEN 'warning' ELSE 'success' END AS alert FROM pollution""")
def h14(t: Tables) -> DataFrame:
    return t.pollution.select(
        "reading_id", bands.aqi_band(F.col("AQI")).alias("band"), bands.aqi_alert(F.col("AQI")).alias("alert"))


@query("h15_tiers", """
    SELECT reading_id, CASE WHEN renewable_usage > 15 THEN 'High (>15%)' WHEN renewable_usage > 8 THEN 'Mid (8-15%)' ELSE 'Low (<8%)' END
        AS renewable, CASE WHEN humidity / 10 > 10 THEN 'Critical (>10%)' WHEN humidity / 10 > 5 THEN 'Moderate (5-10%)'
        ELSE 'Normal (<5%)' END AS outage
    FROM energy""")
def h15(t: Tables) -> DataFrame:
    return t.energy.select(
        "reading_id", bands.renewable_tier(F.col("renewable_usage")).alias("renewable"),
        bands.outage_tier(F.col("humidity") / 10).alias("outage"))


@query("h16_score_grade", """
    SELECT reading_id, CASE WHEN humidity >= 80 THEN 'Excellent' WHEN humidity >= 60 THEN 'Good'
        WHEN humidity >= 40 THEN 'Fair' ELSE 'Poor' END AS grade FROM energy""")
def h16(t: Tables) -> DataFrame:
    return t.energy.select("reading_id", bands.score_grade(F.col("humidity")).alias("grade"))


@query("h16_threshold_alerts", """
    SELECT * FROM (WITH s AS (SELECT (SELECT avg("AQI") FROM pollution) AS a,
        (SELECT avg(CAST(congestion_level = 'High' AS INT)) * 100 FROM traffic) AS c,
        (SELECT avg(CAST(power_outage = 1 AS INT)) * 100 FROM energy) AS o),
    f AS (SELECT CASE WHEN a > 200 THEN 'hazardous_aqi' WHEN a > 150 THEN 'unhealthy_aqi' WHEN a > 100 THEN 'moderate_aqi' END AS kind,
            CASE WHEN a > 200 THEN 'danger' ELSE 'warning' END AS level, a AS value FROM s
        UNION ALL SELECT CASE WHEN c > 40 THEN 'severe_congestion' WHEN c > 25 THEN 'elevated_congestion' END,
            CASE WHEN c > 40 THEN 'danger' ELSE 'warning' END, c FROM s
        UNION ALL SELECT CASE WHEN o > 5 THEN 'power_outages' END, 'danger', o FROM s)
    SELECT * FROM f WHERE kind IS NOT NULL
    UNION ALL SELECT 'all_clear', 'success', NULL WHERE NOT EXISTS (SELECT 1 FROM f WHERE kind IS NOT NULL))""",
    rounded="value")
def h16_alerts(t: Tables) -> DataFrame:
    return kpi.alerts(t.traffic, t.energy, t.pollution)


@query("h17_kpi_direction", """
    SELECT reading_id, CASE WHEN is_weekend = 1 THEN temperature - 27 < 0 ELSE temperature - 27 >= 0 END AS good,
        printf('%.1f%% vs prev', abs(temperature - 27)) AS text FROM energy""")
def h17(t: Tables) -> DataFrame:
    delta = F.col("temperature") - 27
    return t.energy.select(
        "reading_id", bands.trend_is_good(delta, F.col("is_weekend") == 1).alias("good"),
        bands.delta_text(delta).alias("text"))


@query("h18_trend_profiles", """
    SELECT reading_id, pow(1.02::DOUBLE, greatest(year - 2010, 0)) AS growth, pow(1.02::DOUBLE, greatest(year - 1990, 0)) AS growth_1990,
        temperature + 4 * sin((hour - 5) * (2 * pi() / 24)) AS diurnal,
        CASE WHEN hour BETWEEN 6 AND 18 THEN greatest(0, 45 * sin((hour - 6) * (pi() / 12))) ELSE 0 END AS solar
    FROM energy""", rounded="growth growth_1990 diurnal solar")
def h18(t: Tables) -> DataFrame:
    return t.energy.select(
        "reading_id", calendar.annual_growth(F.col("year")).alias("growth"),
        calendar.annual_growth(F.col("year") + 20).alias("growth_1990"),
        calendar.diurnal_temperature(F.col("temperature"), F.col("hour")).alias("diurnal"),
        calendar.solar_share(F.col("hour")).alias("solar"))


@query("h19_rush_profile", f"""
    SELECT order_no, part_no, supp_no, line_no, CASE WHEN is_weekend = 1 THEN
        CASE WHEN area IN ({LEISURE_LIST}) THEN CASE WHEN hour BETWEEN 12 AND 20 THEN 1.6 + 0.4 * sin((hour - 12) * pi() / 8) ELSE 0.5 END
             ELSE CASE WHEN hour BETWEEN 10 AND 18 THEN 0.6 ELSE 0.3 END END
        ELSE CASE WHEN hour BETWEEN 8 AND 10 THEN 2.5 + 0.5 * sin((hour - 8) * pi() / 2)
             WHEN hour BETWEEN 17 AND 20 THEN 2.8 + 0.4 * sin((hour - 17) * pi() / 3)
             WHEN hour BETWEEN 11 AND 16 THEN 1.1 WHEN hour BETWEEN 6 AND 7 THEN 1.4 ELSE 0.25 END END AS multiplier
    FROM traffic""", rounded="multiplier")
def h19(t: Tables) -> DataFrame:
    m = calendar.rush_profile(F.col("hour"), F.col("is_weekend"), F.col("area"))
    return t.traffic.select(*TRAFFIC_KEYS, m.alias("multiplier"))


@query("h20_clip_and_casts", """
    SELECT event_id, CASE WHEN value IS NOT NULL AND NOT isnan(value) THEN greatest(10, least(300, value)) END AS clipped,
        abs(CASE WHEN isnan(value) THEN NULL ELSE value END - 50) AS distance,
        coalesce(CASE WHEN isnan(value) THEN NULL ELSE value END, 0) AS filled,
        coalesce(value BETWEEN 20 AND 40, false) AS inside, event_type IN ('click', 'view') AS listed FROM dirty""",
    rounded="clipped distance filled")
def h20(t: Tables) -> DataFrame:
    value = F.nanvl("value", F.lit(None).cast("double"))
    rows = t.dirty.select("event_id", "event_type", value.alias("value"))
    return rows.select(
        "event_id", bands.clip(F.col("value"), 10.0, 300.0).alias("clipped"), F.abs(F.col("value") - 50).alias("distance"),
        F.coalesce("value", F.lit(0.0)).alias("filled"),
        F.coalesce(F.col("value").between(20, 40), F.lit(False)).alias("inside"),
        F.col("event_type").isin("click", "view").alias("listed"))


@query("h21_text_functions", """
    SELECT event_id, lower(trim(event_type)) AS clean, event_type = 'click' AS is_click,
        concat_ws(', ', event_type, day_text) AS joined FROM dirty""")
def h21(t: Tables) -> DataFrame:
    return t.dirty.select(
        "event_id", F.lower(F.trim("event_type")).alias("clean"), (F.col("event_type") == "click").alias("is_click"),
        F.concat_ws(", ", "event_type", "day_text").alias("joined"))


PROPS = StructType([StructField("k", IntegerType())])


@query("a04_json_decode", """
    SELECT coalesce(CASE WHEN json_valid(props) THEN CAST(json_extract(props, '$.k') AS INT) END, -1) AS k, count(*) AS n
    FROM dirty GROUP BY 1""")
def a04(t: Tables) -> DataFrame:
    decoded = messages.decode(t.dirty, PROPS, "props")  # a bad document gives a NULL, shown as -1
    return decoded.groupBy(F.coalesce("k", F.lit(-1)).alias("k")).agg(F.count("*").alias("n"))


@query("h22_json_encode_decode", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k,
        '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS encoded FROM events""")
def h22(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.from_json("props", PROPS).getField("k").alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("encoded"))


@query("a14_keyed_messages", "SELECT CAST(user_id AS VARCHAR) AS key, event_id, user_id, value FROM events")
def a14(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "value")
    sent = messages.encode(rows, "user_id")
    back = F.from_json("value", rows.schema)
    return sent.select("key", back.alias("d")).select("key", "d.*")


@query("h23_iso_text", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, ts AS plain FROM events""")
def h23(t: Tables) -> DataFrame:
    zoned = F.col("ts").cast("timestamp")
    return t.events.select("event_id", calendar.iso_text(zoned).alias("iso"), calendar.strip_zone(zoned).alias("plain"))
