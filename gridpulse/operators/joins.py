"""Dimension, calendar, range, neighbour and cross-domain joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions import constants as K
from gridpulse.scratch import lookup_join


def area_dimension(spark: SparkSession) -> DataFrame:
    """One row per known area: zone, road type, weights, roles (a fixed, small table)."""
    rows = [
        (
            a, zone,
            "Highway" if a in K.HIGHWAY_AREAS else "Street" if a in K.STREET_AREAS else "Main Road",
            K.TRAFFIC_WEIGHT.get(a, 1.0), K.ENERGY_WEIGHT.get(a, 1.0), K.POLLUTION_WEIGHT.get(a, 1.0),
            int(a in K.IT_HUB_AREAS), int(a in K.INDUSTRIAL_AREAS),
        )
        for a, zone in K.AREA_ZONE.items()
    ]
    return spark.createDataFrame(
        rows,
        "area string, zone string, road_type string, traffic_weight double, energy_weight double, "
        "pollution_weight double, is_it_hub int, is_industrial int",
    )


AREA_DEFAULTS = {
    "zone": "Central", "road_type": "Main Road", "traffic_weight": 1.0, "energy_weight": 1.0,
    "pollution_weight": 1.0, "is_it_hub": 0, "is_industrial": 0,
}


def with_area_dimension(df: DataFrame, columns: Sequence[str] = tuple(AREA_DEFAULTS)) -> DataFrame:
    """Look up area attributes; unknown areas get the defaults."""
    dim = area_dimension(df.sparkSession).select("area", *columns)
    joined = df.drop(*columns).join(F.broadcast(dim), "area", "left")
    return joined.fillna({c: AREA_DEFAULTS[c] for c in columns})


def with_frequency(df: DataFrame, lookup: DataFrame, key: str, out: str, stored: bool = False) -> DataFrame:
    """Attach the training frequency of ``key``; unseen keys get 0."""
    return lookup_join(df, lookup.select(key, out), key, "left", stored=stored).fillna({out: 0.0})


def frequency_table(df: DataFrame, key: str, out: str) -> DataFrame:
    """Share of rows per key, the total taken from the counts themselves."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(key, (F.col("n") / total).alias(out))


def scheduled_events(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(K.SCHEDULED_EVENTS, "area string, first string, last string, multiplier double")
    return rows.select("area", F.to_date("first").alias("first"), F.to_date("last").alias("last"), "multiplier")


def event_days(events: DataFrame, key: str) -> DataFrame:
    """Event ranges as one row per key and day: the largest multiplier of events that run all
    that day, and of events that end on it (an event ends at 23:59:59 of its last day)."""
    days = events.filter(F.col("first") <= F.col("last")).select(  # a range that ends before it begins has no day
        F.col("area").alias(key), "multiplier", "last",
        F.explode(F.sequence("first", F.greatest("first", "last"), F.expr("interval 1 day"))).alias("_day"),
    )
    ends = F.col("_day") == F.col("last")
    return days.groupBy(key, "_day").agg(
        F.max(F.when(~ends, F.col("multiplier"))).alias("_through"),
        F.max(F.when(ends, F.col("multiplier"))).alias("_ending"),
    )


def with_event_multiplier(
    df: DataFrame, events: DataFrame, key: str, ts: str, out: str = "event_multiplier"
) -> DataFrame:
    """Largest multiplier of the events running at each row's key and time, 1.0 without one.

    Ranges are whole days, so the range join becomes an equi-join on (key, day):
    rows are never multiplied and overlapping events are merged beforehand.
    """
    calendar = event_days(events, key)
    moment = F.col(ts).cast("timestamp_ntz")
    last_moment = F.to_date(ts).cast("timestamp_ntz") + F.expr("interval '23:59:59' hour to second")
    joined = lookup_join(df.withColumn("_day", F.to_date(ts)), calendar, [key, "_day"])
    ending = F.when(moment <= last_moment, F.col("_ending"))
    return joined.withColumn(out, F.greatest(F.lit(1.0), F.col("_through"), ending)).drop("_day", "_through", "_ending")


def with_holiday_multiplier(df: DataFrame, ts: str, out: str = "holiday_multiplier") -> DataFrame:
    calendar = df.sparkSession.createDataFrame(K.HOLIDAYS, f"_m int, _d int, {out} double")
    on = (F.month(ts) == F.col("_m")) & (F.dayofmonth(ts) == F.col("_d"))
    return df.join(F.broadcast(calendar), on, "left").drop("_m", "_d").fillna({out: 1.0})


def neighbour_edges(spark: SparkSession) -> DataFrame:
    pairs = [(src, dst) for src, dsts in K.NEIGHBOURS.items() for dst in dsts]
    return spark.createDataFrame(pairs, "src string, dst string")


def neighbour_mean(
    keys: DataFrame, edges: DataFrame, metric: DataFrame, key: str, value: str, out: str = "neighbour_mean"
) -> DataFrame:
    """Mean of the neighbours' values per key; an absent value counts 0, no neighbours give 0."""
    values = metric.select(F.col(key).alias("dst"), F.col(value).alias("_v"))
    per_src = (
        edges.join(values, "dst", "left")
        .groupBy(F.col("src").alias(key))
        .agg(F.avg(F.coalesce(F.col("_v"), F.lit(0.0))).alias(out))
    )
    return keys.join(per_src, key, "left").fillna({out: 0.0})


def domain_means(tables: Sequence[tuple[DataFrame, str]], key: str = "area", how: str = "inner") -> DataFrame:
    """Per-key means of several domains side by side (each table is reduced before the join)."""
    means = [df.groupBy(key).agg(F.avg(c).alias(c)) for df, c in tables]
    return reduce(lambda a, b: a.join(b, key, how), means)


def area_risk(
    areas: DataFrame, traffic: DataFrame, energy: DataFrame, pollution: DataFrame, key: str = "area"
) -> DataFrame:
    """Composite risk per listed area, absent domains count 0, highest first."""
    means = [
        traffic.groupBy(key).agg(F.avg("vehicle_count").alias("vehicles")),
        energy.groupBy(key).agg(F.avg("energy_consumption").alias("energy_kwh")),
        pollution.groupBy(key).agg(F.avg("AQI").alias("aqi")),
    ]
    wide = reduce(lambda a, b: a.join(b, key, "left"), means, areas.select(key))
    wide = wide.fillna(0.0, subset=["vehicles", "energy_kwh", "aqi"])
    score = (
        F.col("vehicles") / 1000.0 * 0.3 + F.col("energy_kwh") / 9000.0 * 0.3 + F.col("aqi") / 300.0 * 0.4
    ) * 100.0
    return wide.withColumn("risk_score", score).orderBy(F.desc("risk_score"), key)


def align_streams(traffic: DataFrame, energy: DataFrame, pollution: DataFrame) -> DataFrame:
    """Readings of one area and time from all three domains."""
    on = ["area", "timestamp"]
    return (
        traffic.select(*on, "vehicle_count", "avg_speed")
        .join(energy.select(*on, "energy_consumption"), on)
        .join(pollution.select(*on, "AQI"), on)
    )


def align_means(tables: Sequence[tuple[DataFrame, str]], grain: dict[str, Column]) -> DataFrame:
    """Means of several domains side by side at one time grain; each table is reduced to the grain before the join."""
    names = list(grain)
    means = [df.groupBy(*[c.alias(n) for n, c in grain.items()]).agg(F.avg(value).alias(value), F.count(value).alias(f"n_{value}"))
             for df, value in tables]
    return reduce(lambda a, b: a.join(b, names), means)
