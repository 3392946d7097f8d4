"""Threshold bands, tiers, grades and ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import FREE_FLOW_SPEED, INDUSTRIAL_AREAS, IT_HUB_AREAS, ROAD_CAPACITY


def congestion_band(load: Column) -> Column:
    return F.when(load < 0.5, "Low").when(load < 0.85, "Medium").otherwise("High")


def demand_band(kwh: Column) -> Column:
    return F.when(kwh > 6500, "High").when(kwh > 3000, "Medium").otherwise("Low")


def load_type(area: Column, zone: Column) -> Column:
    return (
        F.when(area.isin(INDUSTRIAL_AREAS), "Industrial")
        .when(area.isin(IT_HUB_AREAS) | (zone == "Central"), "Commercial")
        .otherwise("Residential")
    )


def aqi_band(v: Column) -> Column:
    return (
        F.when(v <= 50, "Good")
        .when(v <= 100, "Moderate")
        .when(v <= 150, "Unhealthy (Sensitive)")
        .when(v <= 200, "Unhealthy")
        .otherwise("Hazardous")
    )


def aqi_alert(v: Column) -> Column:
    return F.when(v > 200, "danger").when(v > 100, "warning").otherwise("success")


def renewable_tier(v: Column) -> Column:
    return F.when(v > 15, "High (>15%)").when(v > 8, "Mid (8-15%)").otherwise("Low (<8%)")


def outage_tier(pct: Column) -> Column:
    return F.when(pct > 10, "Critical (>10%)").when(pct > 5, "Moderate (5-10%)").otherwise("Normal (<5%)")


def score_grade(score: Column) -> Column:
    return (
        F.when(score >= 80, "Excellent").when(score >= 60, "Good").when(score >= 40, "Fair").otherwise("Poor")
    )


def trend_is_good(delta: Column, lower_is_better: Column) -> Column:
    """A rise is good unless lower is better, and the other way round."""
    return (delta >= 0) != lower_is_better


def delta_text(delta: Column) -> Column:
    return F.format_string("%.1f%% vs prev", F.abs(delta))


def rank_in(values: list[str], c: Column) -> Column:
    """0-based place of ``c`` in a fixed order; unknown values come last."""
    rank = F.lit(len(values))
    for i, v in reversed(list(enumerate(values))):
        rank = F.when(c == v, i).otherwise(rank)
    return rank


def by_road(road: Column, values: dict[str, float], default: float) -> Column:
    out = F.lit(default)
    for name, v in values.items():
        out = F.when(road == name, v).otherwise(out)
    return out


def road_capacity(road: Column) -> Column:
    return by_road(road, ROAD_CAPACITY, 750.0)


def free_flow_speed(road: Column) -> Column:
    return by_road(road, FREE_FLOW_SPEED, 55.0)


def flow_speed(vehicles: Column, capacity: Column, free_flow: Column) -> Column:
    """Speed under load: free flow damped by the fourth power of the load ratio, 4 at least."""
    ratio = F.try_divide(vehicles, capacity)
    return F.greatest(F.lit(4.0), free_flow / (1.0 + 0.15 * F.pow(ratio, F.lit(4.0))))


def signal_wait(vehicles: Column) -> Column:
    return F.least(F.lit(300).cast("bigint"), F.floor(vehicles / 5.0))


def clip(c: Column, low: float, high: float) -> Column:
    """Clip; NULL stays NULL (least/greatest alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def ape(actual: Column, predicted: Column) -> Column:
    """Absolute percentage error in 0..50; a wrong guess of a zero actual counts 50."""
    err = F.abs(predicted - actual)
    pct = F.coalesce(F.try_divide(err, F.abs(actual)) * 100.0, F.when(err > 0, 50.0))
    return F.when(err.isNotNull(), F.least(F.lit(50.0), pct))
