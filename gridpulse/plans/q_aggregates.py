"""D-series and F-series: aggregates, distributions, scores, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions import bands, calendar
from gridpulse.functions.constants import AQI_BANDS, SEVERITY_ORDER
from gridpulse.operators import cleaning, joins, kpi, quantiles, stats
from gridpulse.plans.registry import query
from gridpulse.plans.views import AREAS, Tables

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ENERGY = ["energy_consumption", "temperature", "humidity", "renewable_usage"]


def union_sql(template: str, names: list[str]) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in names)


# --- counts, profile, duplicates --------------------------------------------

@query("d01_row_count", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def d01(t: Tables) -> DataFrame:
    df = t.lineitem
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


@query("d02_describe", union_sql(
    "SELECT '{c}' AS \"column\", count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS \"min\", "
    "max({c}) AS \"max\" FROM lineitem", NUMERIC), rounded="mean std")
def d02(t: Tables) -> DataFrame:
    return cleaning.describe(t.lineitem, NUMERIC)


NULL_TEXT = "({c} IS NULL OR lower(trim({c})) IN ('', 'null', 'none', 'nan', 'na', 'n/a'))"


@query("d03_missing_profile", " UNION ALL ".join([
    "SELECT 'event_id' AS \"column\", CAST(count_if(event_id IS NULL) AS BIGINT) AS n_missing FROM dirty",
    "SELECT 'user_id', CAST(count_if(user_id IS NULL) AS BIGINT) FROM dirty",
    "SELECT 'ts', CAST(count_if(ts IS NULL) AS BIGINT) FROM dirty",
    "SELECT 'value', CAST(count_if(value IS NULL OR isnan(value)) AS BIGINT) FROM dirty",
    *[f"SELECT '{c}', CAST(count_if({NULL_TEXT.format(c=c)}) AS BIGINT) FROM dirty"
      for c in ("event_type", "props", "day_text")]]))
def d03(t: Tables) -> DataFrame:
    return cleaning.missing_profile(t.dirty)


@query("d04_duplicates", """
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
    FROM (SELECT count(*) AS n FROM repeated GROUP BY ALL, event_id, user_id, ts, value, event_type, props, day_text)
    """.replace("GROUP BY ALL, ", "GROUP BY "))
def d04(t: Tables) -> DataFrame:
    return cleaning.duplicate_count(t.repeated)


MODE_SQL = """SELECT '{c}' AS "column", {c} AS mode, count(*) AS n FROM dirty WHERE NOT """ + NULL_TEXT + """
    GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1"""


@query("d05_modes", " UNION ALL ".join(f"(SELECT * FROM ({MODE_SQL.format(c=c)}))" for c in ("event_type", "props")))
def d05(t: Tables) -> DataFrame:
    return cleaning.modes(t.dirty, ["event_type", "props"])


@query("d06_impute_mean", """
    SELECT event_id, CASE WHEN value IS NULL OR isnan(value) THEN
        (SELECT avg(value) FROM dirty WHERE value IS NOT NULL AND NOT isnan(value)) ELSE value END AS value
    FROM dirty""", rounded="value")
def d06(t: Tables) -> DataFrame:
    return cleaning.impute_mean(t.dirty.select("event_id", "value"), ["value"])


@query("d07_impute_mode", f"""
    SELECT event_id, CASE WHEN {NULL_TEXT.format(c='event_type')} THEN
        (SELECT mode FROM ({MODE_SQL.format(c='event_type')})) ELSE event_type END AS event_type FROM dirty""")
def d07(t: Tables) -> DataFrame:
    return cleaning.impute_mode(t.dirty.select("event_id", "event_type"), ["event_type"])


@query("d07_impute_all", f"""
    SELECT event_id, CASE WHEN value IS NULL OR isnan(value) THEN
        (SELECT avg(value) FROM dirty WHERE value IS NOT NULL AND NOT isnan(value)) ELSE value END AS value,
        CASE WHEN {NULL_TEXT.format(c='event_type')} THEN
        (SELECT mode FROM ({MODE_SQL.format(c='event_type')})) ELSE event_type END AS event_type FROM dirty""",
    rounded="value")
def d07_all(t: Tables) -> DataFrame:
    return cleaning.impute(t.dirty.select("event_id", "value", "event_type"))


BOUNDS = ["l_quantity", "l_extendedprice"]
BOUNDS_SQL = union_sql(
    "SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem", BOUNDS)
# a narrower fence than 1.5, so that the evenly spread test columns have values outside it
K = 0.25


@query("d08_iqr_bounds", f"""
    SELECT "column", q1, q3, q1 - 1.5 * (q3 - q1) AS "lower", q3 + 1.5 * (q3 - q1) AS "upper" FROM ({BOUNDS_SQL})""",
    rounded="q1 q3 lower upper")
def d08(t: Tables) -> DataFrame:
    return cleaning.bounds_table(cleaning.iqr_bounds(t.lineitem, BOUNDS, exact=True))


@query("d08_iqr_bounds_bracketed", f"""
    SELECT "column", q1, q3, q1 - 1.5 * (q3 - q1) AS "lower", q3 + 1.5 * (q3 - q1) AS "upper" FROM ({BOUNDS_SQL})""",
    rounded="q1 q3 lower upper")
def d08_bracketed(t: Tables) -> DataFrame:
    q = quantiles.exact_quantiles(t.lineitem, BOUNDS, [0.25, 0.75], max_group_rows=5_000)
    long = [F.struct(F.lit(c).alias("column"), F.element_at(c, 1).alias("q1"), F.element_at(c, 2).alias("q3"))
            for c in BOUNDS]
    rows = q.select(F.explode(F.array(*long)).alias("e")).select("e.*")
    spread = F.col("q3") - F.col("q1")
    return rows.withColumns({"lower": F.col("q1") - 1.5 * spread, "upper": F.col("q3") + 1.5 * spread})


@query("d08_iqr_bounds_approx", """SELECT 'l_quantity' AS "column", true AS within_rank_error FROM lineitem WHERE l_quantity IS NOT NULL
    GROUP BY 1 UNION ALL SELECT 'l_extendedprice', true FROM lineitem GROUP BY 1""")
def d08_approx(t: Tables) -> DataFrame:
    """The sketch's quartiles must lie between the exact quantiles one percent around them."""
    near = cleaning.iqr_bounds(t.lineitem, BOUNDS)
    exact = quantiles.exact_quantiles(t.lineitem, BOUNDS, [0.24, 0.26, 0.74, 0.76]).select(F.struct(*BOUNDS).alias("q")).scalar()
    rows = [F.struct(F.lit(c).alias("column"), (
        F.col(c).getField("q1").between(exact.getField(c)[0], exact.getField(c)[1])
        & F.col(c).getField("q3").between(exact.getField(c)[2], exact.getField(c)[3])).alias("within_rank_error"))
        for c in BOUNDS]
    return near.select(F.explode(F.array(*rows)).alias("e")).select("e.*")


def fence_sql(c: str) -> str:
    return (f"(SELECT quantile_cont({c}, 0.25) - {K} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, "
            f"quantile_cont({c}, 0.75) + {K} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM lineitem)")


@query("d09_outlier_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} < lo OR {c} > hi) AS BIGINT) AS n_outliers "
    f"FROM lineitem, {fence_sql(c)}" for c in BOUNDS))
def d09(t: Tables) -> DataFrame:
    return cleaning.outlier_counts(t.lineitem, cleaning.iqr_bounds(t.lineitem, BOUNDS, K, exact=True))


@query("d10_cap_outliers", f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        least(greatest(l_quantity, a.lo), a.hi) AS l_quantity,
        least(greatest(l_extendedprice, b.lo), b.hi) AS l_extendedprice
    FROM lineitem, {fence_sql('l_quantity')} a, {fence_sql('l_extendedprice')} b""",
    rounded="l_quantity l_extendedprice")
def d10(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *BOUNDS)
    return cleaning.cap_outliers(df, cleaning.iqr_bounds(df, BOUNDS, K, exact=True))


@query("d11_recheck_after_cap", """SELECT 'l_quantity' AS "column", count(*) FILTER (WHERE l_quantity < -1e9) AS n_outliers
    FROM lineitem UNION ALL SELECT 'l_extendedprice', count(*) FILTER (WHERE l_extendedprice < -1e9) FROM lineitem""")
def d11(t: Tables) -> DataFrame:
    df = t.lineitem.select(*BOUNDS)
    bounds = cleaning.iqr_bounds(df, BOUNDS, K, exact=True)
    return cleaning.outlier_counts(cleaning.cap_outliers(df, bounds), bounds)


@query("d12_frequency_encoding", """
    SELECT area, count(*) / (SELECT count(*) FROM traffic) AS area_enc FROM traffic GROUP BY area""",
    rounded="area_enc", digits=9)
def d12(t: Tables) -> DataFrame:
    return joins.frequency_table(t.traffic, "area", "area_enc")


# --- group means and pivots ---------------------------------------------------

for _key in ("dayofweek", "year", "hour", "area", "is_it_hub", "is_weekend"):
    query(f"d13_mean_by_{_key}", f"""
        SELECT {_key}, avg(vehicle_count) AS avg_vehicle_count, avg(avg_speed) AS avg_avg_speed
        FROM traffic GROUP BY {_key}""", rounded="avg_vehicle_count avg_avg_speed")(
        lambda t, k=_key: stats.group_mean(t.traffic, [k], ["vehicle_count", "avg_speed"]))

for _view, _a, _b, _value in (
    ("traffic", "season", "weather", "vehicle_count"), ("energy", "hour", "is_weekend", "energy_consumption"),
    ("traffic", "hour", "road_type", "avg_speed"), ("pollution", "zone", "area", "AQI"),
    ("pollution", "hour", "season", "AQI"), ("energy", "zone", "power_outage", "energy_consumption"),
):
    query(f"d14_mean_by_{_a}_{_b}", f"""
        SELECT {_a}, {_b}, avg("{_value}") AS "avg_{_value}" FROM {_view} GROUP BY 1, 2""", rounded=f"avg_{_value}")(
        lambda t, v=_view, a=_a, b=_b, c=_value: stats.group_mean(getattr(t, v), [a, b], [c]))


@query("d15_weather_volume_speed", """
    SELECT weather, avg(vehicle_count) AS avg_vehicle_count, avg(avg_speed) AS avg_avg_speed FROM traffic GROUP BY 1""",
    rounded="avg_vehicle_count avg_avg_speed")
def d15(t: Tables) -> DataFrame:
    return stats.group_mean(t.traffic, ["weather"], ["vehicle_count", "avg_speed"])


@query("d16_mean_std_band", """
    SELECT weather, mean, std, CASE WHEN mean <= 50 THEN 'Good' WHEN mean <= 100 THEN 'Moderate'
        WHEN mean <= 150 THEN 'Unhealthy (Sensitive)' WHEN mean <= 200 THEN 'Unhealthy' ELSE 'Hazardous' END AS band
    FROM (SELECT weather, avg("AQI") AS mean, stddev_samp("AQI") AS std FROM pollution GROUP BY weather)""",
    rounded="mean std")
def d16(t: Tables) -> DataFrame:
    return stats.mean_std(t.pollution, "weather", "AQI").withColumn("band", bands.aqi_band(F.col("mean")))


PIVOTS = {
    "hour_dow": ("traffic", "hour", "dayofweek", list(range(7)), "vehicle_count"),
    "dow_hour": ("traffic", "dayofweek", "hour", list(range(24)), "vehicle_count"),
    "hour_load": ("energy", "hour", "load_type", ["Commercial", "Industrial", "Residential"], "energy_consumption"),
    "load_hour": ("energy", "load_type", "hour", list(range(24)), "energy_consumption"),
    "season_zone": ("energy", "season", "zone", ["Central", "East", "North", "South", "West"], "energy_consumption"),
    "hour_season": ("pollution", "hour", "season", ["Summer", "Monsoon", "Winter"], "AQI"),
}


def pivot_sql(view: str, index: str, column: str, values: list, measure: str) -> str:
    cells = ", ".join(
        f"avg(\"{measure}\") FILTER (WHERE {column} = {v!r}) AS \"{v}\"" for v in values)
    return f"SELECT {index}, {cells} FROM {view} GROUP BY {index}"


for _name, _spec in PIVOTS.items():
    query(f"d17_pivot_{_name}", pivot_sql(*_spec), rounded=" ".join(str(v) for v in _spec[3]))(
        lambda t, s=_spec: stats.pivot_mean(getattr(t, s[0]), *s[1:]))


@query("d17_pivot_area_season_sorted", pivot_sql("energy", "area", "season", ["Summer", "Monsoon", "Winter"],
                                                 "energy_consumption"), rounded="Summer Monsoon Winter")
def d17_sorted(t: Tables) -> DataFrame:
    p = stats.pivot_mean(t.energy, "area", "season", ["Summer", "Monsoon", "Winter"], "energy_consumption")
    return p.orderBy(F.desc("Summer"), "area")


for _view, _column in (("traffic", "congestion_level"), ("energy", "demand_level")):
    query(f"d18_counts_{_column}", f"SELECT {_column}, count(*) AS n FROM {_view} GROUP BY 1")(
        lambda t, v=_view, c=_column: stats.value_counts(getattr(t, v), c))


@query("d18_counts_incident_leading", """
    SELECT incident, count(*) AS n FROM traffic WHERE incident NOT IN ('None') GROUP BY 1 ORDER BY n DESC, 1 LIMIT 8""")
def d18_incident(t: Tables) -> DataFrame:
    return stats.value_counts(t.traffic, "incident", 8, ["None"])


AQI_CASE = """CASE WHEN "AQI" <= 50 THEN 'Good' WHEN "AQI" <= 100 THEN 'Moderate' WHEN "AQI" <= 150 THEN
    'Unhealthy (Sensitive)' WHEN "AQI" <= 200 THEN 'Unhealthy' ELSE 'Hazardous' END"""


@query("d18_counts_aqi_band", f"SELECT {AQI_CASE} AS band, count(*) AS n FROM pollution GROUP BY 1")
def d18_band(t: Tables) -> DataFrame:
    counts = t.pollution.groupBy(bands.aqi_band(F.col("AQI")).alias("band")).agg(F.count("*").alias("n"))
    return cleaning.in_order(counts, "band", AQI_BANDS)


@query("d19_shares_traffic", """
    SELECT avg(CAST(congestion_level = 'High' AS INT)) * 100 AS high_congestion_pct,
        avg(CAST(incident <> 'None' AS INT)) * 100 AS incident_pct FROM traffic""",
    rounded="high_congestion_pct incident_pct")
def d19(t: Tables) -> DataFrame:
    return stats.shares(t.traffic, {
        "high_congestion_pct": F.col("congestion_level") == "High", "incident_pct": F.col("incident") != "None"})


@query("d19_outage_share_by_area", """
    SELECT area, avg(CAST(power_outage = 1 AS INT)) * 100 AS outage_pct FROM energy GROUP BY area""",
    rounded="outage_pct")
def d19_area(t: Tables) -> DataFrame:
    return stats.shares(t.energy, {"outage_pct": F.col("power_outage") == 1}, ["area"])


@query("d20_correlations", " UNION ALL ".join(
    (f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS corr FROM energy" if a != b
     else f"SELECT '{a}' AS x, '{b}' AS y, 1.0::DOUBLE AS corr") for a in ENERGY for b in ENERGY), rounded="corr")
def d20(t: Tables) -> DataFrame:
    return stats.correlations(t.energy, ENERGY)


def histogram_sql(c: str, table: str, bins: int, density: bool = False) -> str:
    extra = f", coalesce(n, 0) / (total * (hi - lo) / {bins}) AS density" if density else ""
    return f"""SELECT CAST(b.range AS INT) AS bin, lo + b.range * ((hi - lo) / {bins}) AS left_edge, coalesce(n, 0) AS n{extra}
        FROM range({bins}) b CROSS JOIN (SELECT min("{c}") AS lo, max("{c}") AS hi, count("{c}") AS total FROM {table}) e
        LEFT JOIN (SELECT CAST(least(floor(("{c}" - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin, count(*) AS n
            FROM {table}, (SELECT min("{c}") AS lo, max("{c}") AS hi FROM {table}) GROUP BY 1) h ON h.bin = b.range"""


for _bins, _view, _c in ((60, "lineitem", "l_extendedprice"), (50, "energy", "energy_consumption"),
                         (40, "pollution", "AQI"), (20, "traffic", "avg_speed")):
    query(f"d21_histogram_{_bins}", histogram_sql(_c, _view, _bins), rounded="left_edge")(
        lambda t, v=_view, c=_c, b=_bins: stats.histogram(getattr(t, v), c, b))


@query("d21_histogram_density", histogram_sql("PM2_5", "pollution", 60, True), rounded="left_edge density", digits=8)
def d21_density(t: Tables) -> DataFrame:
    return stats.histogram(t.pollution, "PM2_5", 60, density=True)


@query("d22_box_by_zone", """
    SELECT * FROM (WITH q AS (SELECT zone, quantile_cont(vehicle_count, 0.25) AS q1, quantile_cont(vehicle_count, 0.5) AS median,
            quantile_cont(vehicle_count, 0.75) AS q3 FROM traffic GROUP BY zone)
    SELECT zone, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
        min(vehicle_count) FILTER (WHERE vehicle_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
        max(vehicle_count) FILTER (WHERE vehicle_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
        CAST(count_if(NOT (vehicle_count BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS BIGINT) AS n_fliers
    FROM traffic JOIN q USING (zone) GROUP BY zone)""", rounded="q1 median q3")
def d22(t: Tables) -> DataFrame:
    return stats.box_stats(t.traffic, "zone", "vehicle_count")


@query("d22_quantiles_split_groups", """
    SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
        quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type""", rounded="q1 median q3")
def d22_split(t: Tables) -> DataFrame:
    q = quantiles.exact_quantiles(t.events, ["value"], [0.25, 0.5, 0.75], ["event_type"], max_group_rows=500)
    return q.select("event_type", *[F.element_at("value", i + 1).alias(n) for i, n in enumerate(("q1", "median", "q3"))])


def kde_sql(table: str, c: str, by: str | None, bins: int, points: int) -> str:
    keys, sel = (f"GROUP BY {by}, ", f"{by}, ") if by else ("GROUP BY ", "")
    using = f"JOIN tot USING ({by})" if by else "CROSS JOIN tot"
    tot_group = f"GROUP BY {by}" if by else ""
    return f"""SELECT * FROM (WITH e AS (SELECT min("{c}") AS lo, max("{c}") AS hi FROM {table}),
    b AS (SELECT {sel} least(floor(("{c}" - lo) / ((hi - lo) / {bins})), {bins - 1}) AS b, count(*) AS n, any_value(lo) AS lo,
        any_value(hi) AS hi FROM {table}, e {keys} least(floor(("{c}" - lo) / ((hi - lo) / {bins})), {bins - 1})),
    tot AS (SELECT {sel} count(*)::DOUBLE AS total, stddev_samp("{c}") * pow(count(*)::DOUBLE, -0.2) AS bw FROM {table} {tot_group})
    SELECT {sel} CAST(g.range AS INT) AS point, any_value(lo + g.range * (hi - lo) / {points - 1}) AS x,
        sum(n * exp(-0.5 * pow((lo + g.range * (hi - lo) / {points - 1} - (lo + (b + 0.5) * (hi - lo) / {bins})) / bw, 2))
            / (total * bw * 2.5066282746310002)) AS density
    FROM b {using} CROSS JOIN range({points}) g {keys} g.range)"""


@query("d23_density", kde_sql("events", "value", None, 256, 101), rounded="x density", digits=8)
def d23(t: Tables) -> DataFrame:
    return stats.density_curve(t.events, "value")


@query("d23_density_by_category", kde_sql("events", "value", "event_type", 256, 101), rounded="x density", digits=8)
def d23_by(t: Tables) -> DataFrame:
    return stats.density_curve(t.events, "value", by="event_type")


for _view, _key, _c in (("traffic", "road_type", "vehicle_count"), ("energy", "power_outage", "energy_consumption"),
                        ("pollution", "is_it_hub", "AQI")):
    query(f"d24_mean_ci_{_key}", f"""
        SELECT {_key}, n, mean, mean - 1.96 * s / sqrt(n) AS ci_low, mean + 1.96 * s / sqrt(n) AS ci_high FROM (
            SELECT {_key}, count("{_c}") AS n, avg("{_c}") AS mean, stddev_samp("{_c}") AS s FROM {_view} GROUP BY 1)""",
        rounded="mean ci_low ci_high")(lambda t, v=_view, k=_key, c=_c: stats.mean_ci(getattr(t, v), k, c))


@query("d25_linear_trend", """
    SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept
    FROM lineitem""", rounded="slope intercept", digits=4)
def d25(t: Tables) -> DataFrame:
    return stats.linear_trend(t.lineitem, "l_quantity", "l_extendedprice")


@query("d26_quadratic_trend", """
    SELECT * FROM (WITH r AS (SELECT l_quantity - m AS u, l_extendedprice AS v, m FROM lineitem, (SELECT avg(l_quantity) AS m FROM lineitem)),
    s AS (SELECT count(*)::DOUBLE AS n, any_value(m) AS m, sum(u) AS s1, sum(u*u) AS s2, sum(u*u*u) AS s3, sum(u*u*u*u) AS s4,
        sum(v) AS t0, sum(u*v) AS t1, sum(u*u*v) AS t2 FROM r),
    d AS (SELECT m, n*(s2*s4-s3*s3) - s1*(s1*s4-s2*s3) + s2*(s1*s3-s2*s2) AS det,
        t0*(s2*s4-s3*s3) - s1*(t1*s4-t2*s3) + s2*(t1*s3-t2*s2) AS x0,
        n*(t1*s4-t2*s3) - t0*(s1*s4-s2*s3) + s2*(s1*t2-s2*t1) AS x1,
        n*(s2*t2-s3*t1) - s1*(s1*t2-s2*t1) + t0*(s1*s3-s2*s2) AS x2 FROM s)
    SELECT x2/det AS c2, x1/det - 2*(x2/det)*m AS c1, x0/det - (x1/det)*m + (x2/det)*m*m AS c0 FROM d)""",
    rounded="c2 c1 c0", digits=4)
def d26(t: Tables) -> DataFrame:
    return stats.quadratic_trend(t.lineitem, "l_quantity", "l_extendedprice")


@query("d27_zone_rollup", """
    SELECT zone, area, CAST(grouping_id(zone, area) AS INT) AS level, sum(m) AS size, sum(m * m) / sum(m) AS colour
    FROM (SELECT zone, area, avg("AQI") AS m FROM pollution GROUP BY 1, 2) GROUP BY ROLLUP (zone, area)""",
    rounded="size colour")
def d27(t: Tables) -> DataFrame:
    return stats.zone_rollup(t.pollution, "zone", "area", "AQI")


# --- scores and KPIs ------------------------------------------------------------

NAMED_TRAFFIC = "(SELECT * REPLACE (CASE WHEN incident = 'None' THEN 'No Incident' ELSE incident END AS incident) FROM traffic)"
CV = "CASE WHEN avg(\"{c}\") > 0 THEN least(stddev_samp(\"{c}\") / avg(\"{c}\"), 1) ELSE 0 END"
SCORE_SQL = f"""
    SELECT * FROM (WITH t AS (SELECT avg(vehicle_count) AS mean, avg(CAST(congestion_level = 'High' AS INT)) AS congested,
            avg(CAST(incident <> 'No Incident' AS INT)) AS incident, {CV.format(c='vehicle_count')} AS cv FROM {NAMED_TRAFFIC}),
    e AS (SELECT avg(energy_consumption) AS mean, avg(power_outage) AS outage, avg(renewable_usage) AS renewable,
            {CV.format(c='energy_consumption')} AS cv FROM energy),
    p AS (SELECT avg("AQI") AS mean, {CV.format(c='AQI')} AS cv FROM pollution),
    s AS (SELECT
        greatest(0, least(100, 100 * (1 - (0.5 * t.mean / 1000 + 0.3 * congested + 0.2 * incident)))) AS traffic_score,
        greatest(0, least(100, 100 * ((1 - e.mean / 9000) * 0.6 + (1 - outage) * 0.3 + renewable / 50 * 0.1))) AS energy_score,
        greatest(0, least(100, 100 * (1 - p.mean / 300))) AS pollution_score,
        greatest(0, least(100, 100 * (1 - (t.cv + e.cv + p.cv) / 3))) AS stability_score FROM t, e, p),
    c AS (SELECT *, greatest(0, least(100, 0.30 * traffic_score + 0.25 * energy_score + 0.35 * pollution_score
        + 0.10 * stability_score)) AS city_score FROM s)
    SELECT *, CASE WHEN city_score >= 80 THEN 'Excellent' WHEN city_score >= 60 THEN 'Good'
        WHEN city_score >= 40 THEN 'Fair' ELSE 'Poor' END AS grade FROM c)"""


def named_traffic(t: Tables) -> DataFrame:
    return cleaning.named_defaults(t.traffic, {"incident": "No Incident"})


@query("d28_city_score", SCORE_SQL,
       rounded="traffic_score energy_score pollution_score stability_score city_score")
def d28(t: Tables) -> DataFrame:
    return kpi.city_score(named_traffic(t), t.energy, t.pollution)


@query("d29_coefficient_of_variation", f"SELECT area, {CV.format(c='AQI')} AS cv FROM pollution GROUP BY area", rounded="cv")
def d29(t: Tables) -> DataFrame:
    return t.pollution.groupBy("area").agg(kpi.coefficient_of_variation("AQI").alias("cv"))


RISK_SQL = """
    SELECT area, coalesce(v, 0) AS vehicles, coalesce(k, 0) AS energy_kwh, coalesce(q, 0) AS aqi,
        (coalesce(v, 0) / 1000 * 0.3 + coalesce(k, 0) / 9000 * 0.3 + coalesce(q, 0) / 300 * 0.4) * 100 AS risk_score
    FROM (SELECT DISTINCT area FROM traffic)
    LEFT JOIN (SELECT area, avg(vehicle_count) AS v FROM traffic GROUP BY 1) USING (area)
    LEFT JOIN (SELECT area, avg(energy_consumption) AS k FROM energy WHERE zone <> 'West' GROUP BY 1) USING (area)
    LEFT JOIN (SELECT area, avg("AQI") AS q FROM pollution WHERE zone <> 'North' GROUP BY 1) USING (area)"""


def risk(t: Tables) -> DataFrame:
    return joins.area_risk(t.traffic.select("area").distinct(), t.traffic, t.energy.filter("zone <> 'West'"),
                           t.pollution.filter("zone <> 'North'"))


@query("d30_area_risk", RISK_SQL, rounded="vehicles energy_kwh aqi risk_score")
def d30(t: Tables) -> DataFrame:
    return risk(t)


def delta_sql(view: str, column: str, n: int) -> str:
    return f"""SELECT '{column}' AS metric, CASE WHEN max(total) >= {2 * n} THEN round(
        (avg("{column}") FILTER (WHERE rn <= {n}) - avg("{column}") FILTER (WHERE rn > {n}))
        / abs(avg("{column}") FILTER (WHERE rn > {n})) * 100, 1) END AS delta_pct
    FROM (SELECT *, row_number() OVER (ORDER BY timestamp DESC, reading_id DESC) AS rn, count(*) OVER () AS total FROM {view})"""


@query("d31_recent_change", delta_sql("pollution", "AQI", 200))
def d31(t: Tables) -> DataFrame:
    return kpi.recent_change(t.pollution, "AQI", "timestamp", ["reading_id"], 200)


@query("d31_recent_change_all_metrics", " UNION ALL ".join(
    delta_sql("energy", c, 200) for c in ENERGY))
def d31_all(t: Tables) -> DataFrame:
    return kpi.recent_changes(t.energy, ENERGY, "timestamp", ["reading_id"], 200)


@query("d31_too_few_rows", delta_sql("pollution", "AQI", 1_000_000))
def d31_few(t: Tables) -> DataFrame:
    return kpi.recent_change(t.pollution, "AQI", "timestamp", ["reading_id"], 1_000_000)


@query("d32_kpi_traffic", f"""
    SELECT avg(vehicle_count) AS avg_vehicles, avg(avg_speed) AS avg_speed, avg(signal_wait_time) AS avg_wait,
        avg(CAST(congestion_level = 'High' AS INT)) * 100 AS high_congestion_pct,
        CAST(count_if(incident <> 'No Incident') AS BIGINT) AS incidents, avg(vehicle_count * 1.1) AS avg_predicted
    FROM {NAMED_TRAFFIC}""", rounded="avg_vehicles avg_speed avg_wait high_congestion_pct avg_predicted")
def d32_traffic(t: Tables) -> DataFrame:
    return kpi.kpis(named_traffic(t).withColumn("predicted_vehicle_count", F.col("vehicle_count") * 1.1), "traffic")


@query("d32_kpi_energy", """
    SELECT avg(energy_consumption) AS avg_consumption, avg(renewable_usage) AS avg_renewable,
        avg(temperature) AS avg_temperature, avg(humidity) AS avg_humidity,
        avg(CAST(power_outage = 1 AS INT)) * 100 AS outage_pct, avg(energy_consumption * 1.1) AS avg_predicted FROM energy""",
    rounded="avg_consumption avg_renewable avg_temperature avg_humidity outage_pct avg_predicted")
def d32_energy(t: Tables) -> DataFrame:
    return kpi.kpis(t.energy.withColumn("predicted_energy_consumption", F.col("energy_consumption") * 1.1), "energy")


@query("d32_kpi_pollution", """
    SELECT avg("AQI") AS avg_aqi, avg("PM2_5") AS avg_pm2_5, avg("PM10") AS avg_pm10, avg("NO2") AS avg_no2,
        avg("CO") AS avg_co, avg("AQI" * 1.1) AS avg_predicted FROM pollution""",
    rounded="avg_aqi avg_pm2_5 avg_pm10 avg_no2 avg_co avg_predicted")
def d32_pollution(t: Tables) -> DataFrame:
    return kpi.kpis(t.pollution.withColumn("predicted_AQI", F.col("AQI") * 1.1), "pollution")


@query("d32_kpi_city", f"""
    SELECT (SELECT city_score FROM ({SCORE_SQL})) AS city_score, (SELECT avg(vehicle_count) FROM traffic) AS avg_vehicles,
        (SELECT avg(avg_speed) FROM traffic) AS avg_speed, (SELECT avg(energy_consumption) FROM energy) AS avg_consumption,
        (SELECT avg(renewable_usage) FROM energy) AS avg_renewable, (SELECT avg("AQI") FROM pollution) AS avg_aqi,
        (SELECT avg(CAST(congestion_level = 'High' AS INT)) * 100 FROM traffic) AS high_congestion_pct""",
    rounded="city_score avg_vehicles avg_speed avg_consumption avg_renewable avg_aqi high_congestion_pct")
def d32_city(t: Tables) -> DataFrame:
    return kpi.city_kpis(named_traffic(t), t.energy, t.pollution)


# --- model quality ---------------------------------------------------------------

SCORED_SQL = "(SELECT l_returnflag, l_extendedprice AS actual, 1500 + l_quantity * 1450 AS predicted FROM lineitem)"


def scored(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_returnflag", F.col("l_extendedprice").alias("actual"), (1500 + F.col("l_quantity") * 1450).alias("predicted"))


@query("d37_regression_metrics", f"""
    SELECT count(*) AS n, sqrt(avg((actual - predicted) ** 2)) AS rmse, avg(abs(actual - predicted)) AS mae,
        avg((actual - predicted) ** 2) AS mse, 1 - avg((actual - predicted) ** 2) / var_pop(actual) AS r2
    FROM {SCORED_SQL}""", rounded="rmse mae mse r2", digits=5)
def d37(t: Tables) -> DataFrame:
    return stats.regression_metrics(scored(t), "actual", "predicted")


@query("d38_residuals", f"""
    SELECT l_returnflag, avg(actual - predicted) AS mean_residual, avg(abs(actual - predicted)) AS mean_abs_error,
        quantile_cont(abs(actual - predicted), 0.5) AS median_abs_error FROM {SCORED_SQL} GROUP BY 1""",
    rounded="mean_residual mean_abs_error median_abs_error")
def d38(t: Tables) -> DataFrame:
    rows = scored(t).withColumns({
        "residual": F.col("actual") - F.col("predicted"), "error": F.abs(F.col("actual") - F.col("predicted"))})
    means = rows.groupBy("l_returnflag").agg(
        F.avg("residual").alias("mean_residual"), F.avg("error").alias("mean_abs_error"))
    medians = quantiles.exact_quantiles(rows, ["error"], [0.5], ["l_returnflag"]).select(
        "l_returnflag", F.element_at("error", 1).alias("median_abs_error"))
    same = means["l_returnflag"].eqNullSafe(medians["l_returnflag"])
    return means.join(medians, same).drop(medians["l_returnflag"])


@query("d39_absolute_percentage_error", f"""
    SELECT l_returnflag, avg(least(50, abs(predicted - actual) / abs(actual) * 100)) AS mean_ape,
        max(least(50, abs(predicted - actual) / abs(actual) * 100)) AS max_ape FROM {SCORED_SQL} GROUP BY 1""",
    rounded="mean_ape max_ape")
def d39(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("ape", bands.ape(F.col("actual"), F.col("predicted")))
    return rows.groupBy("l_returnflag").agg(F.avg("ape").alias("mean_ape"), F.max("ape").alias("max_ape"))


# --- sort, limit, top-k -----------------------------------------------------------

@query("f01_sort_by_time", "SELECT event_id, ts, value FROM events")
def f01(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts", "value").orderBy("ts", "event_id")


for _name, _view, _c, _agg in (
    ("volume", "traffic", "vehicle_count", "avg(vehicle_count)"),
    ("energy", "energy", "energy_consumption", "avg(energy_consumption)"),
    ("aqi", "pollution", "AQI", 'avg("AQI")'),
    ("renewable", "energy", "renewable_usage", "avg(renewable_usage)"),
):
    query(f"f02_leaders_{_name}", f"""
        SELECT area, {_agg} AS mean FROM {_view} GROUP BY area ORDER BY mean DESC, area LIMIT 8""", rounded="mean")(
        lambda t, v=_view, c=_c: stats.top_groups(getattr(t, v), "area", {"mean": F.avg(c)}, "mean", 8))


@query("f02_leaders_outage", """
    SELECT area, avg(power_outage) * 100 AS outage_pct, CASE WHEN avg(power_outage) * 100 > 10 THEN 'Critical (>10%)'
        WHEN avg(power_outage) * 100 > 5 THEN 'Moderate (5-10%)' ELSE 'Normal (<5%)' END AS tier
    FROM energy GROUP BY area ORDER BY outage_pct DESC, area LIMIT 8""", rounded="outage_pct")
def f02_outage(t: Tables) -> DataFrame:
    top = stats.top_groups(t.energy, "area", {"outage_pct": F.avg("power_outage") * 100.0}, "outage_pct", 8)
    return top.withColumn("tier", bands.outage_tier(F.col("outage_pct")))


@query("f03_leaders_volume_speed", """
    SELECT area, avg(vehicle_count) AS vehicles, avg(avg_speed) AS speed FROM traffic GROUP BY area
    ORDER BY vehicles DESC, area LIMIT 10""", rounded="vehicles speed")
def f03(t: Tables) -> DataFrame:
    measures = {"vehicles": F.avg("vehicle_count"), "speed": F.avg("avg_speed")}
    return stats.top_groups(t.traffic, "area", measures, "vehicles", 10)


@query("f04_last_rows", """
    SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 200""")
def f04(t: Tables) -> DataFrame:
    return quantiles.last_rows(t.events.select("event_id", "ts", "value"), "ts", ["event_id"], 200)


@query("f05_domain_order", f"""
    SELECT band, n, rank FROM (SELECT {AQI_CASE} AS band, count(*) AS n FROM pollution GROUP BY 1) JOIN (VALUES
        ('Good', 0), ('Moderate', 1), ('Unhealthy (Sensitive)', 2), ('Unhealthy', 3), ('Hazardous', 4)) o(band, rank)
    USING (band)""")
def f05(t: Tables) -> DataFrame:
    counts = t.pollution.groupBy(bands.aqi_band(F.col("AQI")).alias("band")).agg(F.count("*").alias("n"))
    return counts.withColumn("rank", bands.rank_in(AQI_BANDS, F.col("band"))).orderBy("rank")


@query("f06_first_rows", "SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 3")
def f06(t: Tables) -> DataFrame:
    return t.events.select("event_id", "ts").orderBy("ts", "event_id").limit(3)
