"""Row-level model features of the three datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bands import road_capacity
from .calendar import peak_flag


def add_missing(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add derived columns that are not there yet, leaving existing ones alone."""
    return df.withColumns({k: v for k, v in columns.items() if k not in df.columns})


def discomfort_index(temperature: Column, humidity: Column) -> Column:
    return temperature - 0.55 * (1.0 - humidity / 100.0) * (temperature - 14.5)


def traffic_features(df: DataFrame) -> DataFrame:
    df = add_missing(df, {
        "is_peak_hour": peak_flag(F.col("hour"), "traffic"),
        "road_capacity": road_capacity(F.col("road_type")),
    })
    return add_missing(df, {
        "speed_to_capacity_ratio": F.try_divide(F.col("avg_speed"), F.col("road_capacity")),
        "speed_x_peak": F.col("avg_speed") * F.col("is_peak_hour"),
        "hour_x_capacity": F.col("hour") * F.col("road_capacity"),
    })


def energy_features(df: DataFrame) -> DataFrame:
    t, h = F.col("temperature"), F.col("humidity")
    df = add_missing(df, {"is_peak_hour": peak_flag(F.col("hour"), "energy")})
    return add_missing(df, {
        "temp_humidity_discomfort": discomfort_index(t, h),
        "high_temp_flag": (t > 30).cast("int"),
        "very_high_temp": (t > 34).cast("int"),
        "is_extreme_cold": (t < 18).cast("int"),
        "temp_squared": t * t,
        "temp_humidity_interaction": t * h,
        "peak_temp_interaction": F.col("is_peak_hour") * t,
    })


def pollution_features(df: DataFrame) -> DataFrame:
    t, h = F.col("temperature"), F.col("humidity")
    return add_missing(df, {
        "temp_humidity_interaction": t * h,
        "temp_inversion_risk": F.try_divide(t, h + 1.0),
        "peak_hour": peak_flag(F.col("hour"), "pollution"),
        "low_humidity_flag": (h < 45).cast("int"),
    })
