"""C-series: joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions import constants as K
from gridpulse.operators import joins, ranges
from gridpulse.plans.q_aggregates import RISK_SQL, risk
from gridpulse.plans.registry import query
from gridpulse.plans.views import Tables


def values_sql(rows: list[tuple], columns: str, alias: str) -> str:
    body = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) {alias}({columns}))"


@query("c01_frequency_lookup", """
    SELECT e.reading_id, e.area, coalesce(f.area_enc, 0) AS area_enc FROM energy e LEFT JOIN (
        SELECT area, count(*) / (SELECT count(*) FROM energy WHERE zone <> 'North') AS area_enc FROM energy
        WHERE zone <> 'North' GROUP BY area) f USING (area)""", rounded="area_enc", digits=9)
def c01(t: Tables) -> DataFrame:
    freq = joins.frequency_table(t.energy.filter("zone <> 'North'"), "area", "area_enc")
    return joins.with_frequency(t.energy.select("reading_id", "area"), freq, "area", "area_enc")


@query("c02_context_carried_through", """
    SELECT a.reading_id, b.area, b.zone, b.timestamp, a.scaled FROM
        (SELECT reading_id, energy_consumption * 2 AS scaled FROM energy) a JOIN
        (SELECT reading_id, area, zone, timestamp FROM energy) b USING (reading_id)""", rounded="scaled")
def c02(t: Tables) -> DataFrame:
    # the columns stay on the row, so nothing has to be joined back
    return t.energy.select("reading_id", "area", "zone", "timestamp", (F.col("energy_consumption") * 2).alias("scaled"))


MEANS = {"traffic": "vehicle_count", "energy": "energy_consumption", "pollution": "AQI"}
for _a, _b in (("traffic", "pollution"), ("energy", "pollution"), ("traffic", "energy")):
    query(f"c03_area_means_{_a}_{_b}", f"""
        SELECT area, "{MEANS[_a]}", "{MEANS[_b]}" FROM (SELECT area, avg("{MEANS[_a]}") AS "{MEANS[_a]}" FROM {_a} GROUP BY 1)
        JOIN (SELECT area, avg("{MEANS[_b]}") AS "{MEANS[_b]}" FROM {_b} GROUP BY 1) USING (area)""",
        rounded=f"{MEANS[_a]} {MEANS[_b]}")(
        lambda t, a=_a, b=_b: joins.domain_means([(getattr(t, a), MEANS[a]), (getattr(t, b), MEANS[b])]))


@query("c04_risk_with_absent_areas", RISK_SQL, rounded="vehicles energy_kwh aqi risk_score")
def c04(t: Tables) -> DataFrame:
    return risk(t)


DIM = [(a, z, "Highway" if a in K.HIGHWAY_AREAS else "Street" if a in K.STREET_AREAS else "Main Road",
        K.TRAFFIC_WEIGHT.get(a, 1.0), K.ENERGY_WEIGHT.get(a, 1.0), K.POLLUTION_WEIGHT.get(a, 1.0),
        int(a in K.IT_HUB_AREAS), int(a in K.INDUSTRIAL_AREAS)) for a, z in K.AREA_ZONE.items()]


@query("c05_area_dimension", f"""
    SELECT e.reading_id, e.area, coalesce(d.zone, 'Central') AS zone, coalesce(d.road_type, 'Main Road') AS road_type,
        coalesce(d.traffic_weight, 1)::DOUBLE AS traffic_weight, coalesce(d.energy_weight, 1)::DOUBLE AS energy_weight,
        coalesce(d.pollution_weight, 1)::DOUBLE AS pollution_weight, coalesce(d.is_it_hub, 0) AS is_it_hub,
        coalesce(d.is_industrial, 0) AS is_industrial
    FROM (SELECT reading_id, CASE WHEN zone = 'Central' THEN 'Elsewhere' ELSE area END AS area FROM energy) e LEFT JOIN
    {values_sql(DIM, 'area, zone, road_type, traffic_weight, energy_weight, pollution_weight, is_it_hub, is_industrial', 'v')} d
    USING (area)""")
def c05(t: Tables) -> DataFrame:
    area = F.when(F.col("zone") == "Central", "Elsewhere").otherwise(F.col("area"))
    return joins.with_area_dimension(t.energy.select("reading_id", area.alias("area")))


EVENTS = [("Whitefield", "1996-01-10", "1996-03-20", 1.6), ("Whitefield", "1996-03-01", "1997-06-30", 1.4),
          ("Koramangala", "1998-04-05", "1999-04-06", 1.5), ("MG Road", "1995-01-01", "1995-12-31", 1.2),
          ("Silk Board", "2000-05-01", "2000-05-01", 0.5)]


@query("c06_event_multiplier", f"""
    SELECT e.reading_id, e.area, e.timestamp, greatest(1, coalesce(max(m), 1))::DOUBLE AS event_multiplier FROM energy e
    LEFT JOIN {values_sql(EVENTS, 'area, f, l, m', 'v')} v ON v.area = e.area AND e.timestamp >= v.f::TIMESTAMP
        AND e.timestamp <= v.l::TIMESTAMP + INTERVAL 1 DAY - INTERVAL 1 SECOND
    GROUP BY 1, 2, 3""")
def c06(t: Tables) -> DataFrame:
    events = t.spark.createDataFrame(EVENTS, "area string, first string, last string, multiplier double")
    events = events.withColumns({"first": F.to_date("first"), "last": F.to_date("last")})
    return joins.with_event_multiplier(t.energy.select("reading_id", "area", "timestamp"), events, "area", "timestamp")


@query("c06_ranges_by_second", """
    SELECT e.reading_id, e.area, e.timestamp, max(r.m) AS multiplier, count(r.m) AS n_ranges FROM energy e
    LEFT JOIN (SELECT l_suppkey % 41 AS k, epoch(l_shipdate::TIMESTAMP)::BIGINT + l_orderkey % 86399 AS f,
            epoch(l_shipdate::TIMESTAMP)::BIGINT + 86400 * l_quantity::BIGINT + l_partkey % 86399 AS l, 1 + l_discount AS m FROM lineitem) r
        ON r.k = e.reading_id % 41 AND epoch(e.timestamp)::BIGINT BETWEEN r.f AND r.l
    GROUP BY 1, 2, 3""", rounded="multiplier")
def c06_seconds(t: Tables) -> DataFrame:
    """Ranges that begin and end at any second, one for each line item, met by every reading of their key."""
    def second(c: str):
        return F.unix_timestamp(F.col(c).cast("timestamp"))

    spans = t.lineitem.select((F.col("l_suppkey") % 41).alias("k"), (second("l_shipdate") + F.col("l_orderkey") % 86399).alias("low"),
                              (second("l_shipdate") + 86400 * F.col("l_quantity").cast("long") + F.col("l_partkey") % 86399).alias("high"), (1 + F.col("l_discount")).alias("m"))
    rows = t.energy.select("reading_id", "area", "timestamp", (F.col("reading_id") % 41).alias("k"))
    found = ranges.join_ranges(rows, spans, ["k"], second("timestamp"), "low", "high", {
        "multiplier": (F.max("m"), F.greatest), "n_ranges": (F.count("*"), ranges.total)})
    return found.drop("k").fillna({"n_ranges": 0})


EDGES = [(s, d) for s, ds in K.NEIGHBOURS.items() for d in ds]


@query("c07_neighbour_mean", f"""
    SELECT * FROM (WITH m AS (SELECT area, avg(vehicle_count) AS v FROM traffic WHERE zone <> 'West' GROUP BY area),
    n AS (SELECT e.src, avg(coalesce(m.v, 0)) AS nm FROM {values_sql(EDGES, 'src, dst', 'e')} e LEFT JOIN m ON m.area = e.dst GROUP BY 1)
    SELECT area, coalesce(nm, 0) AS neighbour_mean FROM (SELECT DISTINCT area FROM traffic) LEFT JOIN n ON n.src = area)""",
    rounded="neighbour_mean")
def c07(t: Tables) -> DataFrame:
    metric = t.traffic.filter("zone <> 'West'").groupBy("area").agg(F.avg("vehicle_count").alias("v"))
    areas = t.traffic.select("area").distinct()
    return joins.neighbour_mean(areas, joins.neighbour_edges(t.spark), metric, "area", "v")


@query("c08_holiday_multiplier", f"""
    SELECT reading_id, timestamp, coalesce(mult, 1)::DOUBLE AS holiday_multiplier FROM energy
    LEFT JOIN {values_sql(K.HOLIDAYS, 'm, d, mult', 'h')} h ON month(timestamp) = m AND day(timestamp) = d""")
def c08(t: Tables) -> DataFrame:
    return joins.with_holiday_multiplier(t.energy.select("reading_id", "timestamp"), "timestamp")


@query("c09_align_domains", """
    SELECT area, timestamp, t.v AS vehicle_count, t.s AS avg_speed, e.k AS energy_consumption, p.q AS "AQI"
    FROM (SELECT area, timestamp, energy_consumption / 10 AS v, temperature AS s FROM energy) t
    JOIN (SELECT area, timestamp, energy_consumption AS k FROM energy WHERE load_type <> 'Industrial') e USING (area, timestamp)
    JOIN (SELECT area, timestamp, humidity AS q FROM energy WHERE weather <> 'Rain') p USING (area, timestamp)""",
    rounded="vehicle_count energy_consumption")
def c09(t: Tables) -> DataFrame:
    e = t.energy
    return joins.align_streams(
        e.select("area", "timestamp", (F.col("energy_consumption") / 10).alias("vehicle_count"),
                 F.col("temperature").alias("avg_speed")),
        e.filter("load_type <> 'Industrial'"),
        e.filter("weather <> 'Rain'").withColumn("AQI", F.col("humidity")))


ALIGNED_SQL = " JOIN ".join(
    f'(SELECT month(timestamp)::INTEGER AS month, day(timestamp)::INTEGER AS day, avg("{c}") AS "{c}", count("{c}") AS "n_{c}" FROM {v} GROUP BY ALL)'
    for v, c in (("traffic", "vehicle_count"), ("energy", "energy_consumption"), ("pollution", "AQI")))


ALIGNED_TABLES_SQL = "SELECT * FROM " + ALIGNED_SQL.replace(") JOIN (", ") AS a JOIN (", 1).replace(
    ") JOIN (", ") AS b USING (month, day) JOIN (", 1) + " AS c USING (month, day)"


@query("c09_align_tables", ALIGNED_TABLES_SQL, rounded="vehicle_count energy_consumption AQI")
def c09_tables(t: Tables) -> DataFrame:
    """The three tables whole; their years differ, so they meet by calendar day."""
    grain = {"month": F.month("timestamp"), "day": F.dayofmonth("timestamp")}
    return joins.align_means([(t.traffic, "vehicle_count"), (t.energy, "energy_consumption"), (t.pollution, "AQI")], grain)


NATION_MEANS_SQL = """
    SELECT r_name, n_name, orders_mean, line_mean, balance_mean FROM nation JOIN region ON n_regionkey = r_regionkey
    JOIN (SELECT c_nationkey AS k, avg(o_totalprice) AS orders_mean FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) USING (k)
    JOIN (SELECT s_nationkey AS k, avg(l_extendedprice) AS line_mean FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1) USING (k)
    JOIN (SELECT c_nationkey AS k, avg(c_acctbal) AS balance_mean FROM customer GROUP BY 1) USING (k)"""


@query("c03_three_domain_means_by_nation", NATION_MEANS_SQL.replace("FROM nation JOIN", "FROM (SELECT *, n_nationkey AS k FROM nation) JOIN"),
       rounded="orders_mean line_mean balance_mean", digits=5)
def c03_nation(t: Tables) -> DataFrame:
    # Facts are reduced by their own foreign key before they meet a dimension.
    def by_nation(fact, fk, measure, dim, key, nation, out):
        part = fact.groupBy(F.col(fk).alias("k")).agg(F.sum(measure).alias("s"), F.count(measure).alias("c"))
        joined = part.join(dim.select(F.col(key).alias("k"), F.col(nation).alias("n_nationkey")), "k")
        return joined.groupBy("n_nationkey").agg((F.sum("s") / F.sum("c")).alias(out))

    parts = [
        by_nation(t.orders, "o_custkey", "o_totalprice", t.customer, "c_custkey", "c_nationkey", "orders_mean"),
        by_nation(t.lineitem, "l_suppkey", "l_extendedprice", t.supplier, "s_suppkey", "s_nationkey", "line_mean"),
        t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.avg("c_acctbal").alias("balance_mean")),
    ]
    zones = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    wide = reduce(lambda a, b: a.join(b, "n_nationkey"), parts, zones)
    return wide.select("r_name", "n_name", "orders_mean", "line_mean", "balance_mean")
