"""Profiling, de-duplication, imputation, rule checks and outlier capping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.functions.bands import rank_in
from gridpulse.functions.predicates import is_measure, missing, nan_to_null, null_like
from gridpulse.operators.quantiles import approx_quantiles, exact_quantiles
from gridpulse.scratch import materialize


def long_counts(counts: DataFrame, key: str = "column", value: str = "n") -> DataFrame:
    """One row of counts to one row per count."""
    return counts.unpivot([], counts.columns, key, value)


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, one scan and one partial aggregate."""
    counts = df.agg(*[F.count_if(missing(f)).alias(f.name) for f in df.schema.fields])
    return long_counts(counts, "column", "n_missing")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min and max per numeric column, long form."""
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).cast("double").alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*per_column).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def parse_time(df: DataFrame, column: str, text: str | None = None) -> DataFrame:
    """Parse ISO text into ``column`` and drop rows that do not parse."""
    source = F.col(text or column)
    if isinstance(df.schema[text or column].dataType, T.StringType):
        df = df.withColumn(column, F.try_to_timestamp(source))
    return df.filter(F.col(column).isNotNull())


def named_defaults(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Give null-like text a name where its absence has a meaning."""
    present = {c: d for c, d in defaults.items() if c in df.columns}
    return df.withColumns({c: F.when(null_like(c), F.lit(d)).otherwise(F.col(c)) for c, d in present.items()})


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent valid value per text column; ties go to the smaller value."""
    long = df.select(*columns).unpivot([], list(columns), "column", "value")
    valid = long.filter(~null_like("value"))
    counts = valid.groupBy("column", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value")))
    return counts.groupBy("column").agg(best.alias("b")).select(
        "column", F.col("b.value").alias("mode"), (-F.col("b.neg")).alias("n")
    )


def _with_scalar(df: DataFrame, row: DataFrame, name: str, store: bool) -> DataFrame:
    """Attach a one-row, one-column result to every row as one scalar sub-query.

    Stored, it is computed once and not again by every job that reads the rows.
    """
    return df.withColumn(name, (materialize(row, "scalar") if store else row).scalar())


def impute_mean(df: DataFrame, columns: Sequence[str] | None = None, store: bool = False) -> DataFrame:
    """NULL and NaN measures become the column mean (one scalar sub-query for all columns)."""
    columns = list(columns or [f.name for f in df.schema.fields if is_measure(f)])
    if not columns:
        return df
    means = df.agg(F.struct(*[F.avg(nan_to_null(c)).alias(c) for c in columns]).alias("m"))
    placed = _with_scalar(df, means, "_means", store)
    return placed.withColumns({
        c: F.coalesce(nan_to_null(c), F.col("_means").getField(c)) for c in columns
    }).drop("_means")


def impute_mode(df: DataFrame, columns: Sequence[str], store: bool = False) -> DataFrame:
    """Null-like text becomes the column's mode."""
    columns = list(columns)
    if not columns:
        return df
    best = modes(df, columns).agg(F.map_from_entries(F.collect_list(F.struct("column", "mode"))).alias("m"))
    placed = _with_scalar(df, best, "_modes", store)  # one entry per column
    return placed.withColumns({
        c: F.when(null_like(c), F.coalesce(F.try_element_at("_modes", F.lit(c)), F.col(c))).otherwise(F.col(c))
        for c in columns
    }).drop("_modes")


def impute(df: DataFrame, exclude: Sequence[str] = (), store: bool = False) -> DataFrame:
    """Mean for measures and mode for text."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    measures = [f.name for f in fields if is_measure(f)]
    if measures:
        df = impute_mean(df, measures, store)
    return impute_mode(df, [f.name for f in fields if isinstance(f.dataType, T.StringType)], store)


def iqr_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5, exact: bool = False) -> DataFrame:
    """One row, one struct (q1, q3, lower, upper) per column; all columns in one aggregation."""
    columns = list(columns)
    q = exact_quantiles(df, columns, [0.25, 0.75]) if exact else approx_quantiles(df, columns, [0.25, 0.75])

    def fence(c: str) -> Column:
        q1, q3 = F.element_at(c, 1).cast("double"), F.element_at(c, 2).cast("double")
        return F.struct(
            q1.alias("q1"), q3.alias("q3"),
            (q1 - k * (q3 - q1)).alias("lower"), (q3 + k * (q3 - q1)).alias("upper"),
        ).alias(c)

    return q.select(*[fence(c) for c in columns])


def bounds_table(bounds: DataFrame) -> DataFrame:
    """The bounds row as one row per column."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("b")) for c in bounds.columns]
    return bounds.select(F.explode(F.array(*entries)).alias("e")).select("e.column", "e.b.*")


def _with_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    return _with_scalar(df, bounds.select(F.struct(*bounds.columns).alias("b")), "_bounds", False)


def _fence(column: str) -> tuple[Column, Column]:
    b = F.col("_bounds").getField(column)
    return b.getField("lower"), b.getField("upper")


def outlier_counts(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Values outside their fence, per column. The bounds can be stored ones, for a recheck."""

    def outside(c: str) -> Column:
        lo, hi = _fence(c)
        return F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c)

    counts = _with_bounds(df.select(*bounds.columns), bounds).agg(*[outside(c) for c in bounds.columns])
    return long_counts(counts, "column", "n_outliers")


def cap_outliers(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Pull values to their fence; NULL stays NULL."""

    def capped(c: str) -> Column:
        lo, hi = _fence(c)
        return F.when(F.col(c) < lo, lo).when(F.col(c) > hi, hi).otherwise(F.col(c))

    return _with_bounds(df, bounds).withColumns({c: capped(c) for c in bounds.columns}).drop("_bounds")


def violations(df: DataFrame, broken: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, all rules in one scan."""
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in broken.items()])
    return long_counts(counts, "rule", "n_rows")


def rules(dataset: str) -> dict[str, Column]:
    """Rows that break a range or a cross-field rule. Thresholds per dataset."""
    c = F.col
    if dataset == "traffic":
        return {
            "vehicle_count_negative": c("vehicle_count") < 0,
            "avg_speed_out_of_range": (c("avg_speed") < 0) | (c("avg_speed") > 120),
            "signal_wait_out_of_range": (c("signal_wait_time") < 0) | (c("signal_wait_time") > 300),
            "low_congestion_high_volume": (c("congestion_level") == "Low") & (c("vehicle_count") > 800),
            "heavy_rain_high_speed": (c("weather") == "Heavy Rain") & (c("avg_speed") > 60),
            "low_volume_long_wait": (c("vehicle_count") < 100) & (c("signal_wait_time") > 200),
        }
    if dataset == "energy":
        return {
            "consumption_negative": c("energy_consumption") < 0,
            "temperature_out_of_range": (c("temperature") < -50) | (c("temperature") > 60),
            "humidity_out_of_range": (c("humidity") < 0) | (c("humidity") > 100),
            "renewable_out_of_range": (c("renewable_usage") < 0) | (c("renewable_usage") > 100),
            "high_demand_low_use": (c("demand_level") == "High") & (c("energy_consumption") < 3000),
            "low_demand_high_use": (c("demand_level") == "Low") & (c("energy_consumption") > 6500),
            "night_renewable": c("hour").between(0, 5) & (c("renewable_usage") > 20),
            "day_no_renewable": c("hour").between(10, 16) & (c("renewable_usage") < 1),
        }
    if dataset == "pollution":
        negative = {f"{m.lower()}_negative": c(m) < 0 for m in ["AQI", "PM2_5", "PM10", "NO2", "CO"]}
        return {
            **negative,
            "temperature_too_low": c("temperature") < -50,
            "humidity_negative": c("humidity") < 0,
        }
    raise ValueError(f"no rules for {dataset}")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail while the plan is built, before any job runs."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def in_order(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.orderBy(rank_in(values, F.col(column)))
