"""Headline numbers, composite scores, recent-versus-prior changes and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.bands import clip, score_grade
from gridpulse.functions.predicates import nan_to_null
from gridpulse.operators.quantiles import day_of_latest, latest_since
from gridpulse.scratch import materialize

PREDICTIONS = {"traffic": ("predicted_vehicle_count",), "energy": ("predicted_energy_consumption",), "pollution": ("predicted_AQI",)}


def pct(condition: Column) -> Column:
    return F.avg(condition.cast("int")) * 100.0


def mean(column: str) -> Column:
    """The mean of the values there are; NaN counts as missing."""
    return F.avg(nan_to_null(column))


def coefficient_of_variation(value: str) -> Column:
    """Sample deviation over mean, 1 at most, 0 unless the mean is positive."""
    average = mean(value)
    return F.when(average > 0, F.least(F.stddev_samp(nan_to_null(value)) / average, F.lit(1.0))).otherwise(0.0)


def kpis(df: DataFrame, dataset: str) -> DataFrame:
    """One row of headline numbers per dataset, one scan; scored rows also give the mean of their predictions."""
    predicted = [mean(c).alias("avg_predicted") for c in PREDICTIONS.get(dataset, ()) if c in df.columns]
    if dataset == "traffic":
        return df.agg(
            mean("vehicle_count").alias("avg_vehicles"),
            mean("avg_speed").alias("avg_speed"),
            mean("signal_wait_time").alias("avg_wait"),
            pct(F.col("congestion_level") == "High").alias("high_congestion_pct"),
            F.count_if(F.col("incident") != "No Incident").alias("incidents"), *predicted,
        )
    if dataset == "energy":
        return df.agg(
            mean("energy_consumption").alias("avg_consumption"),
            mean("renewable_usage").alias("avg_renewable"),
            mean("temperature").alias("avg_temperature"),
            mean("humidity").alias("avg_humidity"),
            pct(F.col("power_outage") == 1).alias("outage_pct"), *predicted,
        )
    if dataset == "pollution":
        return df.agg(*[mean(c).alias(f"avg_{c.lower()}") for c in ["AQI", "PM2_5", "PM10", "NO2", "CO"]], *predicted)
    raise ValueError(f"no KPIs for {dataset}")


def _domains(traffic: DataFrame, energy: DataFrame, pollution: DataFrame) -> DataFrame:
    """One row with a struct of each table's figures: each table is read once and the three rows meet as scalar sub-queries."""
    t = traffic.agg(F.struct(
        mean("vehicle_count").alias("mean"),
        (mean("avg_speed") if "avg_speed" in traffic.columns else F.lit(None).cast("double")).alias("speed"),
        F.avg((F.col("congestion_level") == "High").cast("int")).alias("congested"),
        F.avg((F.col("incident") != "No Incident").cast("int")).alias("incident"),
        coefficient_of_variation("vehicle_count").alias("cv"),
    ).alias("t")).scalar()
    e = energy.agg(F.struct(
        mean("energy_consumption").alias("mean"), mean("power_outage").alias("outage"), mean("renewable_usage").alias("renewable"),
        coefficient_of_variation("energy_consumption").alias("cv"),
    ).alias("e")).scalar()
    p = pollution.agg(F.struct(mean("AQI").alias("mean"), coefficient_of_variation("AQI").alias("cv")).alias("p")).scalar()
    return traffic.sparkSession.range(1).select(t.alias("t"), e.alias("e"), p.alias("p"))


def city_score(traffic: DataFrame, energy: DataFrame, pollution: DataFrame) -> DataFrame:
    """Weighted 0..100 score of traffic, energy, pollution and stability."""
    return _scored(_domains(traffic, energy, pollution)).drop("t", "e", "p")


def _scored(parts: DataFrame) -> DataFrame:
    c = F.col
    scored = parts.select(
        "t", "e", "p",
        clip(100.0 * (1.0 - (0.5 * c("t.mean") / 1000.0 + 0.3 * c("t.congested") + 0.2 * c("t.incident"))),
             0.0, 100.0).alias("traffic_score"),
        clip(100.0 * ((1.0 - c("e.mean") / 9000.0) * 0.6 + (1.0 - c("e.outage")) * 0.3
                      + c("e.renewable") / 50.0 * 0.1), 0.0, 100.0).alias("energy_score"),
        clip(100.0 * (1.0 - c("p.mean") / 300.0), 0.0, 100.0).alias("pollution_score"),
        clip(100.0 * (1.0 - (c("t.cv") + c("e.cv") + c("p.cv")) / 3.0), 0.0, 100.0).alias("stability_score"),
    )
    total = (
        0.30 * c("traffic_score") + 0.25 * c("energy_score") + 0.35 * c("pollution_score")
        + 0.10 * c("stability_score")
    )
    return scored.withColumn("city_score", clip(total, 0.0, 100.0)).withColumn(
        "grade", score_grade(c("city_score"))
    )


def recent_change(df: DataFrame, column: str, ts: str, tie: Sequence[str], n: int = 200) -> DataFrame:
    """Change in percent of the latest ``n`` rows' mean against all earlier rows."""
    return recent_changes(df, [column], ts, tie, n)


def recent_changes(df: DataFrame, columns: Sequence[str], ts: str, tie: Sequence[str], n: int = 200) -> DataFrame:
    """``recent_change`` of many columns, one row a metric, NaN counting as missing.

    One scan writes sums per day. They give the totals and the day from which on the latest rows are looked for; the earlier rows are
    the total minus the latest ones, so the table is never sorted and only its last days are read again.
    """
    rows = df.select(*[nan_to_null(c).alias(f"v{i}") for i, c in enumerate(columns)], F.col(ts).alias("ts"),
                     *[F.col(t).alias(f"tie{i}") for i, t in enumerate(tie)])
    values = [f"v{i}" for i in range(len(columns))]
    sums = [f(v).alias(f"{kind}{v}") for kind, f in (("n", F.count), ("s", F.sum)) for v in values]
    days = materialize(rows.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("rows"), *sums), "days")
    recent = latest_since(rows, "ts", [f"tie{i}" for i in range(len(tie))], n, day_of_latest(days, n))
    whole = days.agg(F.struct(*[F.sum(c).alias(c) for c in days.columns if c != "day"]).alias("x")).scalar()
    late = recent.agg(F.struct(*sums).alias("x")).scalar()
    parts = df.sparkSession.range(1).select(whole.alias("a"), late.alias("r"))

    def change(v: str) -> Column:
        recent_mean = F.try_divide(F.col(f"r.s{v}"), F.col(f"r.n{v}"))
        prior_mean = F.try_divide(F.col(f"a.s{v}") - F.col(f"r.s{v}"), F.col(f"a.n{v}") - F.col(f"r.n{v}"))
        return F.when(F.col("a.rows") >= 2 * n, F.round(F.try_divide(recent_mean - prior_mean, F.abs(prior_mean)) * 100.0, 1))

    metrics = F.array(*[F.struct(F.lit(c).alias("metric"), change(v).alias("delta_pct")) for c, v in zip(columns, values)])
    return parts.select(F.explode(metrics).alias("m")).select("m.*")


def alerts(traffic: DataFrame, energy: DataFrame, pollution: DataFrame) -> DataFrame:
    """Threshold alerts as rows; one all-clear row when none fires. Thresholds."""
    aqi = pollution.agg(mean("AQI")).scalar()
    congested = traffic.agg(pct(F.col("congestion_level") == "High")).scalar()
    outage = energy.agg(pct(F.col("power_outage") == 1)).scalar()
    one = traffic.sparkSession.range(1).select(
        aqi.alias("aqi"), congested.alias("congested"), outage.alias("outage")
    )

    def alert(kind: str, level: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(level).alias("level"), value.alias("value"))

    a, c, o = F.col("aqi"), F.col("congested"), F.col("outage")
    fired = F.filter(
        F.array(
            F.when(a > 200, alert("hazardous_aqi", "danger", a))
            .when(a > 150, alert("unhealthy_aqi", "warning", a))
            .when(a > 100, alert("moderate_aqi", "warning", a)),
            F.when(c > 40, alert("severe_congestion", "danger", c))
            .when(c > 25, alert("elevated_congestion", "warning", c)),
            F.when(o > 5, alert("power_outages", "danger", o)),
        ),
        lambda x: x.isNotNull(),
    )
    clear = F.array(alert("all_clear", "success", F.lit(None).cast("double")))
    rows = F.when(F.size(fired) > 0, fired).otherwise(clear)
    return one.select(F.explode(rows).alias("x")).select("x.*")


def city_kpis(traffic: DataFrame, energy: DataFrame, pollution: DataFrame) -> DataFrame:
    """The overview row: city score and one or two headline numbers per domain."""
    return _scored(_domains(traffic, energy, pollution)).select(
        "city_score",
        F.col("t.mean").alias("avg_vehicles"), F.col("t.speed").alias("avg_speed"),
        F.col("e.mean").alias("avg_consumption"), F.col("e.renewable").alias("avg_renewable"),
        F.col("p.mean").alias("avg_aqi"), (F.col("t.congested") * 100.0).alias("high_congestion_pct"),
    )
