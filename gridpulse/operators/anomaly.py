"""Anomaly detection (z-score, IQR fence, rolling deviation) and its reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.bands import rank_in
from gridpulse.functions.constants import SEVERITY_ORDER
from gridpulse.functions.predicates import nan_to_null
from gridpulse.operators.ordered import OrderedFrame, rolling
from gridpulse.operators.quantiles import exact_quantiles
from gridpulse.scratch import lookup_join


def _moments(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("_rows"), F.avg(column).alias("_mu"), F.stddev_samp(column).alias("_sigma")
    )


def _z(column: str) -> Column:
    return F.coalesce(F.when(F.col("_sigma") > 0, F.abs((F.col(column) - F.col("_mu")) / F.col("_sigma"))),
                      F.when(F.col(column).isNotNull(), 0.0))


def z_scores(df: DataFrame, column: str) -> DataFrame:
    """Absolute z-score of each row against the whole table; NaN counts as missing."""
    df = df.withColumn(column, nan_to_null(column))
    stats = _moments(df, column, []).select(F.struct("_mu", "_sigma").alias("s")).scalar()
    placed = df.withColumn("_s", stats)
    placed = placed.withColumns({"_mu": F.col("_s._mu"), "_sigma": F.col("_s._sigma")})
    return placed.withColumn("zscore", _z(column)).drop("_s", "_mu", "_sigma")


def control_band(df: DataFrame, column: str, z: float = 3.0) -> DataFrame:
    mean, std = F.avg(column), F.stddev_samp(column)
    return df.agg(mean.alias("centre"), (mean - z * std).alias("lower"), (mean + z * std).alias("upper"))


def detect_anomalies(
    df: DataFrame, column: str, order: Sequence[str], by: Sequence[str] = (), z_thresh: float = 3.0,
    iqr_k: float = 2.0, window: int = 24, rolling_thresh: float = 2.5, **sizes: int,
) -> DataFrame:
    """Flag rows by z-score, IQR fence or centred rolling deviation, with a severity.

    ``by`` gives each key its own statistics; without it the whole table is one
    series in ``order``. Groups of fewer than 5 rows get no flags.
    """
    keys = list(by)
    df = df.withColumn(column, nan_to_null(column))
    q = exact_quantiles(df, [column], [0.25, 0.75], keys)
    fence = F.element_at(column, 2) - F.element_at(column, 1)
    q = q.select(
        *keys,
        (F.element_at(column, 1) - iqr_k * fence).alias("_lower"),
        (F.element_at(column, 2) + iqr_k * fence).alias("_upper"),
    )
    moments = _moments(df, column, keys)
    rolled = rolling(df, column, window, order, keys, **sizes)
    if keys:
        same = [moments[k].eqNullSafe(q[k]) for k in keys]
        stats = moments.join(q, same).select(*[moments[c] for c in moments.columns], "_lower", "_upper")
        placed = lookup_join(rolled, stats, keys)
    else:
        m = moments.select(F.struct(*moments.columns).alias("s")).scalar()
        b = q.select(F.struct(*q.columns).alias("s")).scalar()
        placed = rolled.withColumns({"_m": m, "_b": b}).withColumns({
            **{c: F.col("_m").getField(c) for c in moments.columns}, **{c: F.col("_b").getField(c) for c in q.columns}
        }).drop("_m", "_b")
    c = F.col(column)
    enough = F.col("_rows") >= 5
    local = F.coalesce(F.when(F.col("roll_std") != 0, F.col("roll_std")), F.col("_sigma"))

    def flag(cond: Column) -> Column:
        return F.coalesce(enough & cond, F.lit(False))

    placed = placed.withColumns({
        "anomaly_zscore_val": F.when(enough, _z(column)).otherwise(0.0),
        "anomaly_iqr": flag((c < F.col("_lower")) | (c > F.col("_upper"))),
        "anomaly_rolling": flag(F.abs(c - F.col("roll_mean")) > rolling_thresh * local),
    })
    placed = placed.withColumn("anomaly_zscore", flag(F.col("anomaly_zscore_val") > z_thresh))
    placed = placed.withColumn(
        "is_anomaly", F.col("anomaly_zscore") | F.col("anomaly_iqr") | F.col("anomaly_rolling")
    )
    z = F.col("anomaly_zscore_val")
    severity = F.when(~F.col("is_anomaly"), "").when(z > 4.0, "HIGH").when(z > 3.0, "MEDIUM").otherwise("LOW")
    return placed.withColumn("anomaly_severity", severity).drop(
        "_rows", "_mu", "_sigma", "_lower", "_upper", "roll_mean", "roll_std"
    )


def summary(df: DataFrame, column: str, label: str, area: str = "area") -> DataFrame:
    """Totals, severities, the worst value, and the area with most anomalies (ties: first name).

    Counted per area first, so the final row merges areas and not rows.
    """
    hit = F.col("is_anomaly")
    sev = F.col("anomaly_severity")
    per_area = df.groupBy(area).agg(
        F.count("*").alias("t"), F.count_if(hit).alias("a"), F.count_if(sev == "HIGH").alias("h"),
        F.count_if(sev == "MEDIUM").alias("m"), F.count_if(sev == "LOW").alias("l"),
        F.max(F.when(hit, F.col(column))).alias("w"),
    )
    worst = F.min(F.when(F.col("a") > 0, F.struct((-F.col("a")).alias("neg"), F.col(area).alias("area"))))
    return per_area.agg(
        F.lit(label).alias("label"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("n_anom"),
        F.coalesce(F.round(F.try_divide(F.sum("a"), F.sum("t")) * 100.0, 1), F.lit(0.0)).alias("pct"),
        F.coalesce(F.sum("h"), F.lit(0)).alias("high"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("medium"),
        F.coalesce(F.sum("l"), F.lit(0)).alias("low"),
        F.max("w").alias("worst"),
        worst.getField("area").alias("worst_area"),
    )


def by_area_and_severity(df: DataFrame, area: str = "area", top: int = 15) -> DataFrame:
    """Counts per area and severity for the areas with most anomalies."""
    counts = df.filter("is_anomaly").groupBy(area, "anomaly_severity").agg(F.count("*").alias("n"))
    best = counts.groupBy(area).agg(F.sum("n").alias("_n")).orderBy(F.desc("_n"), area).limit(top)
    return counts.join(F.broadcast(best), area, "left_semi")  # at most ``top`` rows


METHODS = {"zscore": "anomaly_zscore", "iqr": "anomaly_iqr", "rolling": "anomaly_rolling"}


def by_method(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c)).alias(name) for name, c in METHODS.items()])
    return counts.unpivot([], counts.columns, "method", "n")


def method_overlap(df: DataFrame) -> DataFrame:
    """How many anomalies were found by one, two or all three methods."""
    found = sum((F.col(c).cast("int") for c in METHODS.values()), F.lit(0))
    return df.filter("is_anomaly").groupBy(found.alias("n_methods")).agg(F.count("*").alias("n"))


def anomaly_rate(df: DataFrame, order: Sequence[str], rows: int = 50, min_rows: int = 10, **sizes: int) -> DataFrame:
    """Share of anomalies in the trailing ``rows`` rows, NULL with fewer than ``min_rows``."""
    def rate(w):
        frame = w.rowsBetween(-(rows - 1), 0)
        return F.when(F.count("*").over(frame) >= min_rows, F.avg(F.col("is_anomaly").cast("int")).over(frame) * 100.0)

    return OrderedFrame.of(df, [], order, **sizes).windows({"anomaly_rate": rate}, rows - 1, 0).result()


def anomaly_log(df: DataFrame, columns: Sequence[str], column: str, unit: str) -> DataFrame:
    """All anomalies, most severe first, with display names."""
    log = df.filter("is_anomaly").orderBy(rank_in(SEVERITY_ORDER, F.col("anomaly_severity")), *columns)
    return log.select(
        *columns,
        F.col(column).alias(f"{column} ({unit})"),
        F.col("anomaly_severity").alias("Severity"),
        F.round("anomaly_zscore_val", 2).alias("Z-Score"),
        F.col("anomaly_zscore").alias("By Z-Score"),
        F.col("anomaly_iqr").alias("By IQR"),
        F.col("anomaly_rolling").alias("By Rolling"),
    )

