"""Query registry: each entry pairs a Spark query with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.plans import views


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[views.Tables], DataFrame]
    sql: str | None
    rounded: dict[str, int]


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, rounded: str = "", digits: int = 6):
    """Register ``build(tables)``. ``rounded`` lists the double columns compared at ``digits``."""

    def add(build: Callable[[views.Tables], DataFrame]) -> Callable[[views.Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(name, build, sql, {c: digits for c in rounded.split()})
        return build

    return add


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # file times and ISO text compare as UTC
    # The JVM compiles no method of more bytecode; a stage of many columns would run interpreted, several times slower than without whole-stage code.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 8000)
    q = QUERIES[name]
    df = q.build(views.Tables(spark, sf_dir))
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    return df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in q.rounded.items()}) if q.rounded else df


def oracle(name: str) -> str | None:
    q = QUERIES[name]
    if q.sql is None:
        return None
    sql = q.sql.strip()
    if q.rounded:
        cols = ", ".join(f'round("{c}", {d}) + 0.0::DOUBLE AS "{c}"' for c, d in q.rounded.items())
        sql = f"SELECT * REPLACE ({cols}) FROM ({sql}) AS result"
    return views.with_views(sql)
