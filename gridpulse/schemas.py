"""The three sensor record types, their roles and their column groups."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from gridpulse.functions import features


# fixed values: wire formats, all fields nullable
TRAFFIC = StructType([
    StructField("timestamp", StringType()),
    StructField("area", StringType()),
    StructField("zone", StringType()),
    StructField("vehicle_count", DoubleType()),
    StructField("avg_speed", DoubleType()),
    StructField("congestion_level", StringType()),
    StructField("road_type", StringType()),
    StructField("weather", StringType()),
    StructField("incident", StringType()),
    StructField("severity", StringType()),
    StructField("event", StringType()),
    StructField("signal_wait_time", DoubleType()),
    StructField("is_weekend", IntegerType()),
    StructField("is_it_hub", IntegerType()),
    StructField("season", StringType()),
])
ENERGY = StructType([
    StructField("timestamp", StringType()),
    StructField("area", StringType()),
    StructField("zone", StringType()),
    StructField("weather", StringType()),
    StructField("energy_consumption", DoubleType()),
    StructField("temperature", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("demand_level", StringType()),
    StructField("renewable_usage", DoubleType()),
    StructField("load_type", StringType()),
    StructField("is_weekend", IntegerType()),
    StructField("power_outage", IntegerType()),
    StructField("is_it_hub", IntegerType()),
    StructField("season", StringType()),
])
POLLUTION = StructType([
    StructField("timestamp", StringType()),
    StructField("area", StringType()),
    StructField("zone", StringType()),
    StructField("AQI", DoubleType()),
    StructField("PM2.5", DoubleType()),
    StructField("PM10", DoubleType()),
    StructField("NO2", DoubleType()),
    StructField("CO", DoubleType()),
    StructField("weather", StringType()),
    StructField("temperature", DoubleType()),
    StructField("humidity", DoubleType()),
    StructField("is_weekend", IntegerType()),
    StructField("is_it_hub", IntegerType()),
    StructField("season", StringType()),
])


@dataclass(frozen=True)
class Dataset:
    """Everything the generic cleaning, training and scoring steps need to know."""

    name: str
    wire: StructType
    target: str
    categorical: tuple[str, ...]
    lags: dict[str, int]
    features: Callable[[DataFrame], DataFrame]
    not_features: tuple[str, ...]
    capped: tuple[str, ...]
    required: tuple[str, ...]
    rename: dict[str, str] = field(default_factory=dict)

    @property
    def prediction(self) -> str:
        return f"predicted_{self.target}"

    encoded: tuple[str, ...] = ("area_enc", "is_it_hub", "is_weekend")  # go into the vector unscaled


CALENDAR = ("hour", "day", "dayofweek", "month", "year")

# fixed values: targets, categorical columns, lag names, columns kept out of the models
DATASETS = {
    "traffic": Dataset(
        name="traffic", wire=TRAFFIC, target="vehicle_count",
        categorical=("zone", "road_type", "weather", "incident", "severity", "event", "season"),
        lags={"vehicle_lag1": 1, "vehicle_lag2": 2},
        features=features.traffic_features,
        not_features=("congestion_level", "signal_wait_time"),
        capped=("vehicle_count", "avg_speed", "signal_wait_time"),
        required=("vehicle_count", "avg_speed", "weather", "road_type", "zone", "incident", "season",
                  "is_weekend", "is_it_hub", "event", "area", *CALENDAR),
    ),
    "energy": Dataset(
        name="energy", wire=ENERGY, target="energy_consumption",
        categorical=("zone", "weather", "load_type", "season"),
        lags={"lag_energy1": 1, "lag_energy2": 2},
        features=features.energy_features,
        not_features=("demand_level",),
        encoded=("area_enc", "power_outage", "is_it_hub", "is_weekend"),
        capped=("energy_consumption", "temperature", "humidity", "renewable_usage"),
        required=("energy_consumption", "temperature", "humidity", "weather", "zone", "load_type", "season",
                  "renewable_usage", "power_outage", "is_weekend", "is_it_hub", "area", "demand_level", *CALENDAR),
    ),
    "pollution": Dataset(
        name="pollution", wire=POLLUTION, target="AQI",
        categorical=("zone", "weather", "season"),
        lags={"aqi_lag1": 1, "aqi_lag2": 2},
        features=features.pollution_features,
        not_features=("PM2_5", "PM10", "NO2", "CO"),
        capped=("AQI", "PM2_5", "PM10", "NO2", "CO", "temperature", "humidity"),
        required=("AQI", "temperature", "humidity", "weather", "zone", "season", "is_weekend", "is_it_hub",
                  "area", *CALENDAR),
        rename={"PM2.5": "PM2_5"},
    ),
}
