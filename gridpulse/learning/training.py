"""Encoders, scaler, the four regressors, evaluation, cross-validation and importances."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.learning.prepare import add_features, numeric_features
from gridpulse.operators.joins import frequency_table, with_frequency
from gridpulse.operators.quantiles import chronological_split
from gridpulse.operators.stats import regression_metrics
from gridpulse.schemas import Dataset
from gridpulse.scratch import materialize


T = TypeVar("T")

#: Fits that run beside each other. One fit is hundreds of short jobs, one after the other, which leave most of the cluster idle.
FITS_AT_ONCE = 6

#: Rows of one task of a fit, which it keeps as objects of some 300 bytes and goes through once for each level of each tree.
FIT_ROWS = 500_000


#: Share of the cluster's memory for stored blocks that the fits which run beside each other may fill.
FIT_SHARE = 0.8

_room, _taken = threading.Condition(), {}  # application id -> bytes of its running fits


def kept_bytes(est: Estimator, rows: int, slots: int) -> int:
    """About what a fit keeps stored to go through it again and again: bins, objects, and a tree's count for each row; nothing for linear models."""
    if not isinstance(est, (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor)):
        return 0
    return rows * (4 * slots + 150 + (4 * est.getNumTrees() if isinstance(est, RandomForestRegressor) else 0))


def storage_bytes(spark: SparkSession) -> int:
    """Memory for stored blocks of all executors, of the driver only in local mode."""
    sc = spark.sparkContext._jsc.sc()
    own, found = sc.env().blockManager().blockManagerId().hostPort(), {}
    executors = sc.getExecutorMemoryStatus().iterator()
    while executors.hasNext():
        entry = executors.next()
        found[entry._1()] = entry._2()._1()
    return sum(v for k, v in found.items() if k != own) or found[own]


@contextmanager
def room_for(spark: SparkSession, need: int) -> Iterator[None]:
    """Waits until the rows of a fit find room beside those of the running fits; alone, a fit always begins.

    Rows that find no room lie on disk and are read and made objects anew for each level of each tree, a hundred times over.
    """
    app, most = spark.sparkContext.applicationId, FIT_SHARE * storage_bytes(spark) if need else 0
    with _room:
        _room.wait_for(lambda: not need or not _taken.get(app) or _taken[app] + need <= most)
        _taken[app] = _taken.get(app, 0) + need
    try:
        yield
    finally:
        with _room:
            _taken[app] -= need
            _room.notify_all()


def fit(est: Estimator, rows: DataFrame, count: int, slots: int) -> Model:
    """``est`` fitted when there is room for its rows, dealt over tasks of bounded size if it keeps them."""
    need = kept_bytes(est, count, slots)
    with room_for(rows.sparkSession, need):
        return est.fit(spread(rows, count=count) if need else rows)


def at_once(spark: SparkSession, tasks: Sequence[Callable[[], T]]) -> list[T]:
    """Results of ``tasks`` in their order, a few of them running at a time; the error of one is raised here."""
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        try:
            return [f.result() for f in running]
        finally:
            for f in running:  # those that have not begun are not started after an error
                f.cancel()


def spread(rows: DataFrame, task_rows: int | None = None, count: int | None = None) -> DataFrame:
    """``rows`` dealt evenly over tasks of at most ``task_rows`` rows, a whole number of rounds of the cores; tables that fit one task stay as they are,
    and those whose ``count`` is known also where the tasks that read them are as small on average.

    Stored rows of few columns are so small that one task's stretch of a file holds millions of them, and a fit keeps them as objects.
    """
    n, task_rows = rows.count() if count is None else count, task_rows or FIT_ROWS
    if n <= task_rows or (count is not None and n <= task_rows * rows.rdd.getNumPartitions()):
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(-(-n // (task_rows * cores)) * cores)


def models(target: str) -> dict[str, Estimator]:
    """The four regressors. Depths, counts, rates and seed."""
    c = {"labelCol": target, "featuresCol": "features"}
    return {
        "Linear Regression": LinearRegression(maxIter=100, **c),
        "Decision Tree": DecisionTreeRegressor(maxDepth=10, seed=42, **c),
        "Random Forest": RandomForestRegressor(numTrees=50, maxDepth=10, seed=42, **c),
        "Gradient Boosting": GBTRegressor(maxDepth=5, maxIter=50, stepSize=0.1, subsamplingRate=0.8, seed=42, **c),
    }


def encoder(columns: Sequence[str]) -> Pipeline:
    """String indexes (unseen values kept) and one-hot vectors; one pass finds all labels."""
    indexed = [f"{c}_idx" for c in columns]
    indexer = StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep")
    one_hot = OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_ohe" for c in columns])
    return Pipeline(stages=[indexer, one_hot])


def scaler(columns: Sequence[str]) -> Pipeline:
    """Numeric columns as one vector, divided by their deviation, not centred."""
    gather = VectorAssembler(inputCols=list(columns), outputCol="num_raw", handleInvalid="keep")
    return Pipeline(stages=[gather, StandardScaler(inputCol="num_raw", outputCol="num_scaled", withMean=False)])


def assemble(df: DataFrame, spec: Dataset) -> DataFrame:
    parts = ["num_scaled", *[f"{c}_ohe" for c in spec.categorical], *spec.encoded]
    return VectorAssembler(inputCols=parts, outputCol="features", handleInvalid="keep").transform(df)


def with_vector(df: DataFrame, spec: Dataset, enc: PipelineModel, sca: PipelineModel, numeric: Sequence[str], metadata: dict | None = None) -> DataFrame:
    """``features`` as ``assemble`` over the two fitted pipelines gives it, from one array of plain expressions.

    The pipelines' own transforms build some twenty vectors for each row and hand each one on as a row of its own.
    """
    def number(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))

    scales = [1.0 / v if v else 0.0 for v in sca.stages[-1].std.toArray().tolist()]
    slots = [number(c) * F.lit(x) for c, x in zip(numeric, scales, strict=True)]
    for c, labels in zip(spec.categorical, enc.stages[0].labelsArray, strict=True):
        slots += [F.when(F.col(c) == F.lit(label), 1.0).otherwise(0.0) for label in labels]
    slots += [number(c) for c in spec.encoded]
    # Adding 0.0 turns -0.0 into 0.0, as a vector without its zeros does.
    return df.withColumn("features", array_to_vector(F.array(*[x + F.lit(0.0) for x in slots])).alias("features", metadata=metadata or {}))


@dataclass
class Prepared:
    """Vectorised train and test sets and what is needed to vectorise new rows the same way."""

    train: DataFrame
    test: DataFrame
    encoder: PipelineModel
    scaler: PipelineModel
    frequency: DataFrame
    numeric: list[str]
    feature_names: list[str] = field(default_factory=list)


def prepare(df: DataFrame, spec: Dataset, order: Sequence[str], ignore: Sequence[str] = ()) -> Prepared:
    """Features, chronological 80/20 split, encodings fitted on the train part only.

    Rows with a missing number are left out of training by a plain filter; the
    assemblers' own skip mode would build every vector twice.
    """
    full = materialize(add_features(df, spec, order), f"{spec.name}-features")
    train, test = chronological_split(full, order, 0.8)
    frequency = materialize(frequency_table(train, "area", "area_enc"), f"{spec.name}-frequency")
    numeric = numeric_features(full, spec, ignore)
    train = with_frequency(train, frequency, "area", "area_enc", stored=True)
    test = with_frequency(test, frequency, "area", "area_enc", stored=True)
    numbers = [*numeric, *spec.encoded, spec.target]
    train, test = train.dropna(subset=numbers), test.dropna(subset=numbers)
    enc = encoder(spec.categorical).fit(train)
    sca = scaler(numeric).fit(train)
    described = assemble(sca.transform(enc.transform(train)), spec)  # never run: it names the slots
    names, metadata = feature_names(described, numeric), described.schema["features"].metadata
    vectors = [with_vector(part, spec, enc, sca, numeric, metadata) for part in (train, test)]
    # Only the vector and the target go on; every fit reads these narrow tables.
    stored = [materialize(v.select("features", spec.target), f"{spec.name}-vectors") for v in vectors]
    return Prepared(stored[0], stored[1], enc, sca, frequency, numeric, names)


def feature_names(df: DataFrame, numeric: Sequence[str]) -> list[str]:
    """Names of the vector's slots, from the attribute metadata; scaled slots by column."""
    groups = df.schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a for g in groups.values() for a in g), key=lambda a: a["idx"])
    out = []
    for a in slots:
        name = a.get("name", f"slot_{a['idx']}")
        if name.startswith("num_scaled_"):
            name = numeric[int(name.rsplit("_", 1)[1])]
        out.append(name)
    return out


def scored(model: PipelineModel, rows: DataFrame, target: str) -> DataFrame:
    return regression_metrics(model.transform(rows), target, "prediction")


def fit_all(data: Prepared, chosen: dict[str, Estimator]) -> dict[str, PipelineModel]:
    """Each model fitted on the train part, beside each other."""
    n, slots = data.train.count(), len(data.feature_names)
    fits = [lambda est=est: PipelineModel([fit(est, data.train, n, slots)]) for est in chosen.values()]
    return dict(zip(chosen, at_once(data.train.sparkSession, fits)))


def train_and_evaluate(
    data: Prepared, target: str, chosen: dict[str, Estimator] | None = None
) -> tuple[DataFrame, dict[str, PipelineModel], str]:
    """Fit each model, measure it on the test part in one pass, and name the best by R2."""
    fitted = fit_all(data, chosen or models(target))
    rows = [scored(m, data.test, target).withColumn("model", F.lit(name)) for name, m in fitted.items()]
    table = materialize(reduce(DataFrame.unionByName, rows), "metrics")
    best = table.agg(F.min_by("model", F.struct(-F.col("r2"), F.col("model")))).first()[0]
    return table, fitted, best


def fit_status(train_r2: Column, cv_r2: Column, test_r2: Column) -> Column:
    """Verdict from the three R2 values, first rule that applies."""
    return (
        F.when((train_r2 > 0.9) & (train_r2 - test_r2 > 0.08), "Overfitting")
        .when((train_r2 < 0.75) & (test_r2 < 0.75), "Underfitting")
        .when(F.abs(cv_r2 - test_r2) > 0.05, "Unstable")
        .otherwise("Good Fit")
    )


def cross_validation(
    data: Prepared, target: str, fitted: dict[str, PipelineModel], chosen: dict[str, Estimator], folds: int = 2
) -> DataFrame:
    """Train, cross-validated and test R2 per model, their gap and the verdict."""
    evaluator = RegressionEvaluator(labelCol=target, predictionCol="prediction", metricName="r2")
    # The folds that CrossValidator draws. Its own fit runs them one after the other and then fits the whole train part again, which is ``fitted``.
    drawn, rand = data.train.withColumn("_rand", F.rand(42)), F.col("_rand")
    inside = [(rand >= i * (1.0 / folds)) & (rand < (i + 1) * (1.0 / folds)) for i in range(folds)]
    parts = [(drawn.filter(~c), drawn.filter(c)) for c in inside]

    n, slots = data.train.count() * (folds - 1) // folds, len(data.feature_names)

    def held_out(est: Estimator, train: DataFrame, rest: DataFrame) -> float:
        return float(evaluator.evaluate(fit(est, train, n, slots).transform(rest)))

    turns = [(name, part) for name in reversed(chosen) for part in parts]  # the longest fits, boosting and forest, begin first
    scores = at_once(data.train.sparkSession, [lambda n=name, p=part: held_out(chosen[n], *p) for name, part in turns])
    rows = None
    for name in chosen:
        cv_r2 = sum(r2 for (n, _), r2 in zip(turns, scores) if n == name) / folds
        train = scored(fitted[name], data.train, target).select(F.col("r2").alias("train_r2"))
        test = scored(fitted[name], data.test, target).select("r2").scalar()
        row = train.select(F.lit(name).alias("model"), "train_r2", F.lit(cv_r2).alias("cv_r2"), test.alias("test_r2"))
        rows = row if rows is None else rows.unionByName(row)
    gap = F.col("train_r2") - F.col("test_r2")
    return rows.withColumns({
        "gap": gap, "status": fit_status(F.col("train_r2"), F.col("cv_r2"), F.col("test_r2"))})


def importances(model: PipelineModel, names: Sequence[str], data: DataFrame, top: int | None = None) -> DataFrame:
    """Named feature importances, highest first; no rows for models that have none.

    One row per vector slot, so the table is as small as the model.
    """
    last = model.stages[-1]
    values = last.featureImportances.toArray().tolist() if hasattr(last, "featureImportances") else []
    known = list(names) + [f"slot_{i}" for i in range(len(names), len(values))]
    rows = data.sparkSession.createDataFrame(
        [(n, float(v)) for n, v in zip(known, values)], "feature string, importance double")
    ranked = rows.orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked
