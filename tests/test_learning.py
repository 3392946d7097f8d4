"""Training and scoring: no leakage, unseen categories, rows kept, same twice."""

import threading
import time

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from gridpulse.learning import prepare, scoring, training
from gridpulse.plans import catalog, registry
from gridpulse.plans.views import Tables
from gridpulse.schemas import DATASETS
from gridpulse.scratch import materialize, new_path

catalog.load()
ORDER = ["timestamp", "reading_id"]
SPEC = DATASETS["energy"]


@pytest.fixture(scope="module")
def cleaned(spark, sf):
    return materialize(prepare.clean(Tables(spark, sf).energy, SPEC))


@pytest.fixture(scope="module")
def data(cleaned):
    return training.prepare(cleaned, SPEC, ORDER, ["reading_id"])


@pytest.fixture(scope="module")
def art(data):
    chosen = {"Decision Tree": training.models(SPEC.target)["Decision Tree"]}
    table, fitted, best = training.train_and_evaluate(data, SPEC.target, chosen)
    return scoring.Artefacts.of(SPEC, data, best, fitted[best], table)


def test_frequencies_come_from_the_train_part(data, cleaned):
    assert data.train.count() == int(cleaned.count() * 0.8)
    assert data.train.count() + data.test.count() == cleaned.count()
    assert data.frequency.agg(F.sum("area_enc")).first()[0] == pytest.approx(1.0)


def test_feature_names_cover_the_vector(data):
    assert len(data.feature_names) == data.train.first()["features"].size
    assert {"temperature", "hour", "lag_energy1", "area_enc"} <= set(data.feature_names)
    assert SPEC.target not in data.feature_names and "reading_id" not in data.feature_names


def test_scoring_keeps_every_row_and_repeats_itself(cleaned, art):
    odd = cleaned.withColumns({
        "area": F.when(F.col("hour") == 3, "Nowhere").otherwise(F.col("area")),
        "weather": F.when(F.col("hour") == 4, "Fog").otherwise(F.col("weather")),
        "humidity": F.when(F.col("hour") != 5, F.col("humidity")),
    })
    once, again = scoring.score(odd, art), scoring.score(odd, art)
    assert once.count() == cleaned.count()
    assert once.filter(F.col(SPEC.prediction).isNull()).count() == 0
    assert once.exceptAll(again).count() == 0
    assert set(cleaned.columns) <= set(once.columns)


def test_saved_artefacts_score_the_same(spark, cleaned, art):
    folder = new_path(spark, "art")
    art.save(folder)
    again = scoring.Artefacts.load(spark, folder)
    a = scoring.score(cleaned, art).select("reading_id", SPEC.prediction)
    assert a.exceptAll(scoring.score(cleaned, again).select("reading_id", SPEC.prediction)).count() == 0
    assert again.metrics["features"] == art.metrics["features"]


def test_missing_columns_fail_at_once(cleaned, art):
    with pytest.raises(ValueError, match="load_type"):
        scoring.score(cleaned.drop("load_type"), art)


def test_importances_only_where_a_model_has_them(data, art):
    top = training.importances(art.model, data.feature_names, data.train, 15).collect()
    assert 0 < len(top) <= 15
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)
    linear = {"Linear Regression": training.models(SPEC.target)["Linear Regression"]}
    _, fitted, best = training.train_and_evaluate(data, SPEC.target, linear)
    assert training.importances(fitted[best], data.feature_names, data.train).count() == 0


@pytest.mark.parametrize("r2, verdict", [
    ((0.95, 0.9, 0.8), "Overfitting"), ((0.5, 0.5, 0.5), "Underfitting"), ((0.8, 0.7, 0.8), "Unstable"),
    ((0.92, 0.9, 0.9), "Good Fit"), ((0.95, 0.1, 0.8), "Overfitting"), ((0.9, 0.8, 0.79), "Good Fit")])
def test_fit_status(spark, r2, verdict):
    cols = [F.lit(float(x)) for x in r2]
    assert spark.range(1).select(training.fit_status(*cols).alias("s")).first()["s"] == verdict


@pytest.mark.parametrize("name", DATASETS)
def test_wire_schemas_are_nullable_and_complete(name):
    spec = DATASETS[name]
    assert all(f.nullable for f in spec.wire.fields)
    renamed = {spec.rename.get(f.name, f.name) for f in spec.wire.fields} | {"hour", "day", "dayofweek", "month", "year"}
    assert {spec.target, *spec.categorical, *spec.required, *spec.capped} <= renamed


class Counted(LinearRegression):
    """Waits in its fit until ``barrier`` is full, if there is one, and counts its fits."""

    barrier, fits = None, 0

    def _fit(self, dataset):
        type(self).fits += 1
        if self.barrier is not None:
            self.barrier.wait(timeout=60)
        return super()._fit(dataset)


def test_models_are_fitted_beside_each_other(data, monkeypatch):
    monkeypatch.setattr(Counted, "barrier", threading.Barrier(2))
    chosen = {n: Counted(labelCol=SPEC.target, maxIter=5) for n in ("a", "b")}
    table, fitted, best = training.train_and_evaluate(data, SPEC.target, chosen)
    assert list(fitted) == ["a", "b"] and best == "a" and table.count() == 2


def test_an_error_of_a_fit_is_raised(spark):
    def fail():
        raise ValueError("no such fit")

    with pytest.raises(ValueError, match="no such fit"):
        training.at_once(spark, [lambda: 1, fail])
    assert training.at_once(spark, [lambda n=n: n for n in range(20)]) == list(range(20))


def test_folds_are_those_of_the_cross_validator_and_nothing_is_fitted_twice(data, monkeypatch):
    monkeypatch.setattr(Counted, "fits", 0)
    est = Counted(labelCol=SPEC.target, maxIter=5)
    _, fitted, _ = training.train_and_evaluate(data, SPEC.target, {"m": est})
    got = training.cross_validation(data, SPEC.target, fitted, {"m": est}, folds=3).first()
    assert Counted.fits == 4
    evaluator = RegressionEvaluator(labelCol=SPEC.target, metricName="r2")
    cv = CrossValidator(estimator=est, estimatorParamMaps=[{}], evaluator=evaluator, numFolds=3, seed=42).fit(data.train)
    assert got["cv_r2"] == pytest.approx(cv.avgMetrics[0], abs=1e-9)


def test_tasks_of_a_fit_are_bounded(spark, sf, monkeypatch):
    rows = spark.range(3_000, numPartitions=1).selectExpr("cast(id % 7 as int) AS l_linenumber", "cast(id % 50 as double) AS l_quantity")
    seen = []

    def spread(df):
        out = given(df)
        seen.append([r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()])
        return out

    given = training.spread
    assert given(rows).rdd.getNumPartitions() == 1  # small enough for one task: left alone
    monkeypatch.setattr(training, "FIT_ROWS", 100)
    monkeypatch.setattr(training, "spread", spread)
    tables = Tables(spark, sf)
    monkeypatch.setattr(tables, "lineitem", rows, raising=False)
    found = registry.QUERIES["j08_boosting_group_means"].build(tables).collect()
    assert len(seen) == 1 and max(seen[0]) <= 150 and sum(seen[0]) == 3_000  # dealt in turn by each of the tasks that read
    means = {r[0]: r[1] for r in rows.groupBy("l_linenumber").agg(F.avg(F.col("l_quantity") + 10 * F.col("l_linenumber"))).collect()}
    assert {r["l_linenumber"]: r["prediction"] for r in found} == pytest.approx(means)


def test_vectors_are_those_of_the_pipelines_without_their_steps(data, cleaned, art):
    rows = prepare.add_features(cleaned, SPEC, ORDER).withColumn("area_enc", F.lit(0.25))
    odd = rows.withColumns({
        "zone": F.when(F.col("hour") == 3, "Nowhere").when(F.col("hour") != 4, F.col("zone")),
        "humidity": F.when(F.col("hour") == 5, -0.0).when(F.col("hour") == 6, float("nan")).when(F.col("hour") != 7, F.col("humidity")),
        "power_outage": F.when(F.col("hour") != 8, F.col("power_outage")),
    })
    steps = training.assemble(data.scaler.transform(data.encoder.transform(odd)), SPEC)
    direct = training.with_vector(odd, SPEC, data.encoder, data.scaler, data.numeric)

    def found(df):
        return {r["reading_id"]: [repr(x) for x in r["features"].toArray().tolist()] for r in df.select("reading_id", "features").collect()}

    assert found(direct) == found(steps)
    plan = scoring.score(cleaned, art)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(") <= 2  # the vector and the prediction, not one or more for each text column


class Kept(DecisionTreeRegressor):
    """Notes how many fits run beside each other and the rows of each task."""

    running, most, tasks = 0, 0, []

    def _fit(self, dataset):
        cls = type(self)
        cls.running += 1
        cls.most = max(cls.most, cls.running)
        cls.tasks.append([r[0] for r in dataset.groupBy(F.spark_partition_id()).count().select("count").collect()])
        time.sleep(1)
        try:
            return super()._fit(dataset)
        finally:
            cls.running -= 1


@pytest.mark.parametrize("room, most", [(1, 1), (10**12, 2)])
def test_fits_that_keep_rows_wait_for_room(data, monkeypatch, room, most):
    monkeypatch.setattr(Kept, "most", 0)
    monkeypatch.setattr(training, "storage_bytes", lambda spark: room)
    table, fitted, _ = training.train_and_evaluate(data, SPEC.target, {n: Kept(labelCol=SPEC.target, maxDepth=2) for n in ("a", "b")})
    assert Kept.most == most and list(fitted) == ["a", "b"] and table.count() == 2


def test_room_is_given_back_after_an_error(spark, monkeypatch):
    monkeypatch.setattr(training, "storage_bytes", lambda spark: 1)
    for _ in range(2):
        with pytest.raises(ValueError, match="no fit"), training.room_for(spark, 10):
            raise ValueError("no fit")
    assert training.kept_bytes(LinearRegression(), 10, 3) == 0
    assert training.kept_bytes(RandomForestRegressor(numTrees=50), 10, 3) > training.kept_bytes(DecisionTreeRegressor(), 10, 3) > 0


def test_storage_is_counted(spark):
    assert 10**8 < training.storage_bytes(spark) < 10**10


def test_rows_that_a_fit_keeps_lie_in_tasks_of_bounded_size(data, monkeypatch):
    monkeypatch.setattr(Kept, "tasks", [])
    rows = data.train.coalesce(1)
    n = rows.count()
    training.fit(Kept(labelCol=SPEC.target, maxDepth=2), rows, n, 30)
    monkeypatch.setattr(training, "FIT_ROWS", n // 4)
    training.fit(Kept(labelCol=SPEC.target, maxDepth=2), rows, n, 30)
    assert Kept.tasks[0] == [n] and max(Kept.tasks[1]) <= n // 4 and sum(Kept.tasks[1]) == n
