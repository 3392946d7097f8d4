"""Calendar parts, seasons, labels and time-of-day profiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constants import LEISURE_AREAS


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add hour, day, dayofweek (Monday = 0), month and year where absent."""
    parts = {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "dayofweek": F.weekday(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    }
    return df.withColumns({k: v for k, v in parts.items() if k not in df.columns})


def parse_timestamp(text: Column) -> Column:
    """ISO text to timestamp; NULL (never an error) where it does not parse."""
    return F.try_to_timestamp(text)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def strip_zone(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def season(month: Column) -> Column:
    return (
        F.when(month.between(3, 5), "Summer").when(month.between(6, 9), "Monsoon").otherwise("Winter")
    )


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def day_type(flag: Column) -> Column:
    return F.when(flag == 1, "Weekend").otherwise("Weekday")


def hub_label(flag: Column) -> Column:
    return F.when(flag == 1, "IT Hub").otherwise("Non-Hub")


def outage_label(flag: Column) -> Column:
    return F.when(flag == 1, "Outage").otherwise("Normal")


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEE")


# fixed values: inclusive hour ranges that count as peak, per dataset
PEAK_HOURS = {
    "traffic": [(8, 10), (17, 20)],
    "energy": [(6, 9), (11, 15), (18, 22)],
    "pollution": [(7, 10), (11, 16), (17, 21)],
}


def peak_flag(hour: Column, dataset: str) -> Column:
    flag = F.lit(False)
    for first, last in PEAK_HOURS[dataset]:
        flag = flag | hour.between(first, last)
    return flag.cast("int")


def annual_growth(year: Column) -> Column:
    """2 % a year from 2010, never below 1."""
    return F.pow(F.lit(1.02), F.greatest(year - 2010, F.lit(0)).cast("double"))


def diurnal_temperature(base: Column, hour: Column) -> Column:
    return base + 4.0 * F.sin((hour - 5).cast("double") * (2.0 * math.pi / 24.0))


def solar_share(hour: Column) -> Column:
    """Daylight share of solar generation, 0 at night."""
    curve = 45.0 * F.sin((hour - 6).cast("double") * (math.pi / 12.0))
    return F.when(hour.between(6, 18), F.greatest(F.lit(0.0), curve)).otherwise(0.0)


def rush_profile(hour: Column, weekend: Column, area: Column) -> Column:
    """Traffic multiplier by hour, weekend flag and area role."""
    h = hour.cast("double")
    leisure = area.isin(LEISURE_AREAS)
    weekend_leisure = F.when(
        hour.between(12, 20), 1.6 + 0.4 * F.sin((h - 12.0) * math.pi / 8.0)
    ).otherwise(0.5)
    weekend_other = F.when(hour.between(10, 18), 0.6).otherwise(0.3)
    weekday = (
        F.when(hour.between(8, 10), 2.5 + 0.5 * F.sin((h - 8.0) * math.pi / 2.0))
        .when(hour.between(17, 20), 2.8 + 0.4 * F.sin((h - 17.0) * math.pi / 3.0))
        .when(hour.between(11, 16), 1.1)
        .when(hour.between(6, 7), 1.4)
        .otherwise(0.25)
    )
    return F.when(weekend == 1, F.when(leisure, weekend_leisure).otherwise(weekend_other)).otherwise(weekday)
