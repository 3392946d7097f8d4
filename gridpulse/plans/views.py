"""Input views derived from the given tables, as Spark DataFrames and as SQL text.

Divisors without a finite decimal form keep means away from rounding ties.

The sensor tables are views over ``lineitem`` (traffic), ``orders`` (energy) and
``events`` (pollution): every row of the source becomes one reading. Both sides
are made from the same expressions; only a few functions are spelled differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions import constants as K

AREAS = list(K.AREA_ZONE)
ZONES = list(K.AREA_ZONE.values())
ROADS = [
    "Highway" if a in K.HIGHWAY_AREAS else "Street" if a in K.STREET_AREAS else "Main Road" for a in AREAS
]


class SparkText:
    """Spark spelling of the few functions that differ."""

    @staticmethod
    def shift(ts: str, hours: str, minutes: str) -> str:
        return f"{ts} + make_dt_interval(0, cast({hours} as int), cast({minutes} as int))"

    @staticmethod
    def pick(values: list[str], index: str) -> str:
        items = ", ".join(f"'{v}'" for v in values)
        return f"element_at(array({items}), cast({index} as int) + 1)"

    @staticmethod
    def weekday(ts: str) -> str:
        return f"weekday({ts})"


class DuckText:
    """DuckDB spelling of the same functions."""

    @staticmethod
    def shift(ts: str, hours: str, minutes: str) -> str:
        return f"{ts} + to_hours(cast({hours} as int)) + to_minutes(cast({minutes} as int))"

    @staticmethod
    def pick(values: list[str], index: str) -> str:
        items = ", ".join(f"'{v}'" for v in values)
        return f"([{items}])[cast({index} as int) + 1]"

    @staticmethod
    def weekday(ts: str) -> str:
        return f"cast(isodow({ts}) - 1 as int)"


def _calendar(d) -> dict[str, str]:
    return {
        "hour": "cast(hour(timestamp) as int)",
        "day": "cast(day(timestamp) as int)",
        "dayofweek": d.weekday("timestamp"),
        "month": "cast(month(timestamp) as int)",
        "year": "cast(year(timestamp) as int)",
        "is_weekend": f"CASE WHEN {d.weekday('timestamp')} >= 5 THEN 1 ELSE 0 END",
        "season": "CASE WHEN month(timestamp) IN (3,4,5) THEN 'Summer' "
                  "WHEN month(timestamp) IN (6,7,8,9) THEN 'Monsoon' ELSE 'Winter' END",
    }


def _place(d, index: str) -> dict[str, str]:
    hubs = ", ".join(f"'{a}'" for a in K.IT_HUB_AREAS)
    return {
        "area": d.pick(AREAS, index),
        "zone": d.pick(ZONES, index),
        "is_it_hub": f"CASE WHEN {d.pick(AREAS, index)} IN ({hubs}) THEN 1 ELSE 0 END",
    }


def traffic(d) -> tuple[str, list[dict[str, str]]]:
    index = "l_suppkey % 41"
    return "lineitem", [
        {
            "timestamp": d.shift("l_shipdate", "l_orderkey % 24", "l_partkey % 60"),
            **_place(d, index),
            "road_type": d.pick(ROADS, index),
            "order_no": "l_orderkey", "part_no": "l_partkey", "supp_no": "l_suppkey", "line_no": "l_linenumber",
            "vehicle_count": "CASE WHEN l_partkey % 211 = 0 THEN -5e0 ELSE l_quantity * 22e0 END",
            "avg_speed": "CASE WHEN l_partkey % 97 = 0 THEN -1e0 WHEN l_partkey % 89 = 0 THEN 130e0 "
                         "ELSE 85e0 - l_quantity + cast(l_orderkey % 10 as double) END",
            "weather": d.pick(["Clear", "Rain", "Cloudy", "Heavy Rain"], "l_partkey % 4"),
            "incident": d.pick(["None", "Accident", "None", "Construction", "None", "Roadblock", "None"],
                               "l_linenumber - 1"),
            "severity": d.pick(["None", "Minor", "None", "Major", "None", "Severe", "None"], "l_linenumber - 1"),
            "event": d.pick(["None", "Festival", "None", "Concert", "None"], "l_orderkey % 5"),
            "signal_wait_time": "CASE WHEN l_suppkey % 61 = 0 THEN 350e0 "
                                "WHEN l_quantity < 4e0 AND l_partkey % 3 = 0 THEN 210e0 "
                                "ELSE floor(l_quantity * 44e-1) END",
        },
        {
            "congestion_level": "CASE WHEN l_partkey_mod = 0 THEN 'Low' "
                                "WHEN vehicle_count < 3e2 THEN 'Low' WHEN vehicle_count < 7e2 THEN 'Medium' "
                                "ELSE 'High' END",
            **_calendar(d),
        },
    ]


def energy(d) -> tuple[str, list[dict[str, str]]]:
    return "orders", [
        {
            "timestamp": d.shift("o_orderdate", "o_orderkey % 24", "o_custkey % 60"),
            **_place(d, "o_custkey % 41"),
            "reading_id": "o_orderkey",
            "weather": d.pick(["Clear", "Rain", "Cloudy", "Heavy Rain"], "o_orderkey % 4"),
            "energy_consumption": "CASE WHEN o_orderkey % 307 = 0 THEN -1e0 ELSE o_totalprice / 47e0 END",
            "temperature": "CASE WHEN o_orderkey % 401 = 0 THEN 65e0 "
                           "ELSE 14e0 + cast(o_custkey % 28 as double) END",
            "humidity": "CASE WHEN o_orderkey % 503 = 0 THEN 104e0 "
                        "ELSE 35e0 + cast((o_orderkey + o_custkey) % 61 as double) END",
            "renewable_usage": "CASE WHEN o_orderkey % 601 = 0 THEN -3e0 "
                               "ELSE cast(o_custkey % 46 as double) END",
            "load_type": d.pick(["Industrial", "Commercial", "Residential"], "o_custkey % 3"),
            "power_outage": "CASE WHEN o_orderkey % 16 = 0 THEN 1 ELSE 0 END",
            "demand_level": "CASE WHEN o_orderkey % 29 = 0 THEN 'High' WHEN o_orderkey % 31 = 0 THEN 'Low' "
                            "WHEN o_totalprice / 47e0 > 65e2 THEN 'High' "
                            "WHEN o_totalprice / 47e0 > 3e3 THEN 'Medium' ELSE 'Low' END",
        },
        _calendar(d),
    ]


def pollution(d) -> tuple[str, list[dict[str, str]]]:
    return "events", [
        {
            "timestamp": "ts",
            **_place(d, "user_id % 41"),
            "reading_id": "event_id",
            "AQI": "CASE WHEN event_id % 211 = 0 THEN -4e0 ELSE 2e1 + value / 97e-2 END",
            "PM2_5": "CASE WHEN event_id % 223 = 0 THEN -1e0 ELSE 5e0 + value / 171e-2 END",
            "PM10": "15e0 + value / 123e-2",
            "NO2": "3e0 + value / 353e-2",
            "CO": "CASE WHEN event_id % 227 = 0 THEN -1e0 ELSE 3e-1 + value / 557e-1 END",
            "weather": d.pick(["Clear", "Rain", "Cloudy", "Heavy Rain"], "event_id % 4"),
            "temperature": "CASE WHEN event_id % 401 = 0 THEN -6e1 "
                           "ELSE 14e0 + cast(user_id % 28 as double) END",
            "humidity": "CASE WHEN event_id % 503 = 0 THEN -2e0 "
                        "ELSE 35e0 + cast((event_id + user_id) % 61 as double) END",
        },
        _calendar(d),
    ]


def dirty(d) -> tuple[str, list[dict[str, str]]]:
    """Events with deterministic defects: nulls, NaN, null-like text, bad times, spikes, bad JSON."""
    return "events", [
        {
            "event_id": "event_id", "user_id": "user_id", "ts": "ts",
            "value": "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 "
                     "THEN cast('NaN' as double) WHEN event_id % 101 = 0 THEN value * 2e1 ELSE value END",
            "event_type": "CASE WHEN event_id % 19 = 0 THEN ' None ' WHEN event_id % 29 = 0 THEN 'N/A' "
                          "WHEN event_id % 31 = 0 THEN '' ELSE event_type END",
            "props": "CASE WHEN event_id % 41 = 0 THEN '{bad' ELSE props END",
            "day_text": "CASE WHEN event_id % 37 = 0 THEN 'not-a-time' "
                        "ELSE substr(cast(ts as varchar(40)), 1, 19) END",
        },
    ]


VIEWS = {"traffic": traffic, "energy": energy, "pollution": pollution, "dirty": dirty}
_NEEDS = {"traffic": {"l_partkey_mod": "l_partkey % 53"}}


def _layers(name: str, d) -> tuple[str, list[dict[str, str]]]:
    source, layers = VIEWS[name](d)
    extra = _NEEDS.get(name, {})
    return source, [{**layers[0], **extra}, *layers[1:]]


def view_sql(name: str) -> str:
    """The view as DuckDB SQL text."""
    source, layers = _layers(name, DuckText)
    sql = f"SELECT {', '.join(f'{e} AS "{c}"' for c, e in layers[0].items())} FROM {source}"
    for layer in layers[1:]:
        sql = f"SELECT *, {', '.join(f'{e} AS "{c}"' for c, e in layer.items())} FROM ({sql}) AS base"
    hidden = _NEEDS.get(name)
    return f"SELECT * EXCLUDE ({', '.join(hidden)}) FROM ({sql}) AS base" if hidden else sql


DUP_SQL = "SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE event_id % 50 = 0"


def with_views(sql: str) -> str:
    """Put the views a query names in front of it as common table expressions."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql) or (v == "dirty" and re.search(r"\brepeated\b", sql))]
    parts = [f"{v} AS ({view_sql(v)})" for v in used]
    if re.search(r"\brepeated\b", sql):
        parts.append(f"repeated AS ({DUP_SQL})")
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


class Tables:
    """Lazy access to the given tables and to the derived views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name == "repeated":
            d = self.dirty
            return d.unionByName(d.filter("event_id % 50 = 0"))
        if name not in VIEWS:
            return self.table(name)
        source, layers = _layers(name, SparkText)
        df = self.table(source)
        df = df.selectExpr(*[f"{e} AS `{c}`" for c, e in layers[0].items()])
        for layer in layers[1:]:
            df = df.withColumns({c: F.expr(e) for c, e in layer.items()})
        hidden = _NEEDS.get(name)
        return df.drop(*hidden) if hidden else df
