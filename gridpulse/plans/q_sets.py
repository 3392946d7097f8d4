"""U-series: unions and distinct."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.operators import cleaning, reshape
from gridpulse.plans.registry import query
from gridpulse.plans.views import Tables


@query("u01_merge_batches", "SELECT event_id, event_type, value FROM events")
def u01(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "value")
    click = F.col("event_type") == "click"
    return reshape.merge_batches([rows.filter(click), rows.filter(~click).select("value", "event_id", "event_type")])


@query("u02_merge_history", """
    SELECT reading_id, timestamp, area, energy_consumption, NULL::DOUBLE AS predicted FROM energy
    UNION ALL SELECT event_id, ts, NULL, value, value * 2 FROM events""", rounded="predicted")
def u02(t: Tables) -> DataFrame:
    history = t.energy.select("reading_id", "timestamp", "area", "energy_consumption")
    recent = t.events.select(F.col("event_id").alias("reading_id"), F.col("ts").alias("timestamp"),
                             F.col("value").alias("energy_consumption"), (F.col("value") * 2).alias("predicted"))
    return reshape.merge_history(history, recent, "timestamp", ["reading_id"])


@query("u03_distinct_rows", "SELECT DISTINCT * FROM repeated")
def u03(t: Tables) -> DataFrame:
    return cleaning.drop_duplicates(t.repeated)
