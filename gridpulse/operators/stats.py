"""Group means, pivots, distributions, correlation, trends."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.predicates import nan_to_null
from gridpulse.operators.quantiles import exact_quantiles
from gridpulse.scratch import lookup_join


def group_mean(df: DataFrame, keys: Sequence[str], values: Sequence[str], prefix: str = "avg_") -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(nan_to_null(v)).alias(f"{prefix}{v}") for v in values])


def mean_std(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(nan_to_null(value)).alias("mean"), F.stddev_samp(nan_to_null(value)).alias("std"))


def mean_ci(df: DataFrame, key: str, value: str, z: float = 1.96) -> DataFrame:
    """Group mean with a normal-approximation confidence interval."""
    g = df.select(key, nan_to_null(value).alias(value)).groupBy(key).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("_s")
    )
    half = z * F.col("_s") / F.sqrt(F.col("n").cast("double"))
    return g.select(key, "n", "mean", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


def pivot_mean(df: DataFrame, index: str, column: str, values: Sequence[object], measure: str) -> DataFrame:
    """Table of means. The pivot values are given, so Spark needs no extra job to find them."""
    return df.groupBy(index).pivot(column, list(values)).agg(F.avg(nan_to_null(measure)))


def value_counts(df: DataFrame, column: str, top: int | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    if exclude:
        df = df.filter(~F.col(column).isin(list(exclude)))
    out = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return out.limit(top) if top else out


def shares(df: DataFrame, conditions: dict[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Percentage of rows that meet each condition."""
    return df.groupBy(*keys).agg(*[(F.avg(c.cast("int")) * 100.0).alias(n) for n, c in conditions.items()])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form; each unordered pair is computed once."""
    pairs = list(combinations(columns, 2))
    row = df.agg(*[F.corr(nan_to_null(a), nan_to_null(b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"`{i}`").alias("corr")))
    for c in columns:
        cells.append(F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.lit(1.0).alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("e")).select("e.*")


def histogram(df: DataFrame, column: str, bins: int, density: bool = False) -> DataFrame:
    """Equal-width counts over [min, max], the last bin closed; empty bins are kept, NaN counts as missing."""
    df = df.select(nan_to_null(column).alias(column))
    ends = df.agg(F.struct(
        F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"),
        F.count(column).alias("n"),
    ).alias("e")).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    width = (hi - lo) / bins
    place = F.when(width == 0, 0).otherwise(
        F.least(F.floor(F.try_divide(F.col(column) - lo, width)), F.lit(bins - 1).cast("bigint"))
    ).cast("int")
    counts = df.filter(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = every.join(F.broadcast(counts), "bin", "left").fillna(0, subset=["n"])
    out = out.select("bin", (lo + F.col("bin") * width).alias("left_edge"), "n")
    if density:
        out = out.withColumn("density", F.try_divide(F.col("n"), ends.getField("n") * width))
    return out


def box_stats(df: DataFrame, key: str, value: str, k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside the fence) and fliers per group, also for a missing key."""
    df = df.select(key, nan_to_null(value).alias(value))
    q = exact_quantiles(df, [value], [0.25, 0.5, 0.75], [key]).select(
        key,
        F.element_at(value, 1).alias("q1"),
        F.element_at(value, 2).alias("median"),
        F.element_at(value, 3).alias("q3"),
    )
    joined = lookup_join(df.select(key, value), q, key, "inner")
    spread = F.col("q3") - F.col("q1")
    inside = F.col(value).between(F.col("q1") - k * spread, F.col("q3") + k * spread)
    return joined.groupBy(key).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("n_fliers"),
    )


def density_curve(
    df: DataFrame, column: str, bins: int = 256, points: int = 101, by: str | None = None
) -> DataFrame:
    """Gaussian density estimate on a grid, from binned counts (bins x points terms per group,
    however many rows), with the n^(-1/5) bandwidth rule. Without spread (one row, one value) the density is NULL."""
    keys = [by] if by else []
    df = df.select(*keys, nan_to_null(column).cast("double").alias(column))
    ends = df.agg(F.struct(
        F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"),
    ).alias("e")).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    width = (hi - lo) / bins
    place = F.coalesce(F.least(F.floor(F.try_divide(F.col(column) - lo, width)), F.lit(bins - 1).cast("bigint")), F.lit(0).cast("bigint"))
    off = F.col(column) - (lo + hi) / 2.0  # a large common offset would cancel in the variance
    binned = df.filter(F.col(column).isNotNull()).groupBy(*keys, place.alias("_b")).agg(
        F.count("*").alias("_n"), F.sum(off).alias("_s"), F.sum(off * off).alias("_ss")
    ).withColumn("_x", lo + (F.col("_b") + 0.5) * width)
    total = binned.groupBy(*keys).agg(
        F.sum("_n").cast("double").alias("_t"), F.sum("_s").alias("_m1"), F.sum("_ss").alias("_m2")
    )
    variance = F.try_divide(F.greatest(F.col("_m2") - F.col("_m1") * F.col("_m1") / F.col("_t"), F.lit(0.0)), F.col("_t") - 1.0)
    total = total.select(
        *keys, "_t", F.nullif(F.sqrt(variance) * F.pow(F.col("_t"), F.lit(-0.2)), F.lit(0.0)).alias("_bw")
    )
    if by:
        joined = binned.join(total.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    else:
        one = total.select(F.struct("_t", "_bw").alias("s")).scalar()
        joined = binned.withColumns({"_t": one.getField("_t"), "_bw": one.getField("_bw")})
    grid = joined.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = lo + F.col("point") * (hi - lo) / (points - 1)
    z = (x - F.col("_x")) / F.col("_bw")
    term = F.col("_n") * F.exp(-0.5 * z * z) / (F.col("_t") * F.col("_bw") * 2.5066282746310002)
    return grid.groupBy(*keys, "point").agg(F.first(x).alias("x"), F.sum(term).alias("density"))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    df = df.select(nan_to_null(x).alias("x"), nan_to_null(y).alias("y"))
    return df.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"))


def quadratic_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares parabola ``c2*x^2 + c1*x + c0``: power sums of centred x, then the
    closed 3x3 solution."""
    known = df.select(nan_to_null(x).alias("x"), nan_to_null(y).alias("y")).filter("x is not null and y is not null")
    mean = known.agg(F.avg("x")).scalar()
    rows = known.select((F.col("x") - mean).alias("u"), F.col("y").cast("double").alias("v"), mean.alias("m"))
    u, v = F.col("u"), F.col("v")
    s = rows.agg(
        F.count("*").cast("double").alias("n"), F.first("m").alias("m"),
        F.sum(u).alias("s1"), F.sum(u * u).alias("s2"), F.sum(u * u * u).alias("s3"),
        F.sum(u * u * u * u).alias("s4"), F.sum(v).alias("t0"), F.sum(u * v).alias("t1"),
        F.sum(u * u * v).alias("t2"),
    )
    det = F.expr("n*(s2*s4 - s3*s3) - s1*(s1*s4 - s2*s3) + s2*(s1*s3 - s2*s2)")
    a0 = F.expr("t0*(s2*s4 - s3*s3) - s1*(t1*s4 - t2*s3) + s2*(t1*s3 - t2*s2)")
    a1 = F.expr("n*(t1*s4 - t2*s3) - t0*(s1*s4 - s2*s3) + s2*(s1*t2 - s2*t1)")
    a2 = F.expr("n*(s2*t2 - s3*t1) - s1*(s1*t2 - s2*t1) + t0*(s1*s3 - s2*s2)")
    solved = s.select("m", F.try_divide(a0, det).alias("a0"), F.try_divide(a1, det).alias("a1"),
                      F.try_divide(a2, det).alias("a2"))
    return solved.select(
        F.col("a2").alias("c2"),
        F.expr("a1 - 2*a2*m").alias("c1"),
        F.expr("a0 - a1*m + a2*m*m").alias("c0"),
    )


def zone_rollup(df: DataFrame, parent: str, child: str, value: str) -> DataFrame:
    """Child means, and per parent (and overall) their sum and value-weighted mean."""
    means = df.groupBy(parent, child).agg(F.avg(value).alias("m"))
    return means.rollup(parent, child).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("m").alias("size"),
        F.try_divide(F.sum(F.col("m") * F.col("m")), F.sum("m")).alias("colour"),
    )


def top_groups(df: DataFrame, key: str, measures: dict[str, Column], by: str, n: int) -> DataFrame:
    """Highest groups by one of their aggregates, ties by key."""
    g = df.groupBy(key).agg(*[m.alias(name) for name, m in measures.items()])
    return g.orderBy(F.desc(by), key).limit(n)


def regression_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, MSE and R2 in one pass (total variation from the population variance)."""
    e = F.col(actual) - F.col(predicted)
    g = df.groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(actual).alias("_v"),
        F.count("*").alias("n"),
    )
    return g.select(
        *keys, "n", F.sqrt("mse").alias("rmse"), "mae", "mse",
        (1.0 - F.try_divide(F.col("mse"), F.col("_v"))).alias("r2"),
    )
