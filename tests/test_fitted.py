"""Cleaning fitted on history, and stream scoring with lags that go on from it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridpulse.learning import fitted, prepare, scoring, training
from gridpulse.operators import cleaning
from gridpulse.plans.views import Tables
from gridpulse.schemas import DATASETS
from gridpulse.scratch import materialize, new_path
from gridpulse.sources.messages import read_files_as_stream
from gridpulse.streaming import jobs, state

ORDER = ["timestamp", "reading_id"]
SPEC = DATASETS["energy"]


@pytest.fixture(scope="module")
def raw(spark, sf):
    e = Tables(spark, sf).energy
    return materialize(e.withColumns({
        "energy_consumption": F.when(F.col("reading_id") % 7 == 0, None).when(F.col("reading_id") % 11 == 0, float("nan"))
        .when(F.col("reading_id") % 13 == 0, 1e9).otherwise(F.col("energy_consumption")),
        "weather": F.when(F.col("reading_id") % 5 == 0, " n/a ").otherwise(F.col("weather"))}))


@pytest.fixture(scope="module")
def model(raw):
    return fitted.Cleaning("energy").fit(raw)


def test_same_as_cleaning_the_whole_table(raw, model):
    whole = prepare.clean(raw.unionByName(raw.limit(50)), SPEC).select(sorted(raw.columns))
    ours = model.transform(raw).select(sorted(raw.columns))
    assert ours.count() == whole.count() and ours.exceptAll(whole).count() == 0


def test_result_of_a_row_does_not_hang_on_its_batch(raw, model):
    whole = model.transform(raw)
    parts = [model.transform(raw.where(F.col("reading_id") % 3 == k)) for k in range(3)]
    assert whole.exceptAll(parts[0].unionByName(parts[1]).unionByName(parts[2])).count() == 0


def test_saved_and_loaded(spark, raw, model):
    path = new_path(spark, "cleaning")
    model.write().overwrite().save(path)
    again = fitted.CleaningModel.load(path)
    assert again.statistics() == model.statistics() and again.spec is SPEC
    assert again.transform(raw).exceptAll(model.transform(raw)).count() == 0


def test_no_job_and_no_shuffle(raw, model):
    plan = model.transform(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Subquery" not in plan


def test_empty_history_and_all_missing_columns(raw):
    none = fitted.Cleaning("energy").fit(raw.where("false"))
    assert none.transform(raw).count() == raw.count()
    bare = raw.withColumns({"temperature": F.lit(None).cast("double"), "weather": F.lit(None).cast("string")})
    found = fitted.Cleaning("energy", exact=True).fit(bare)
    assert found.statistics()["means"]["temperature"] is None and "temperature" not in found.statistics()["fences"]
    assert found.transform(bare).where("temperature is not null or weather is not null").count() == 0


def test_rows_without_a_readable_time_go(spark, raw, model):
    text = raw.withColumn("timestamp", F.when(F.col("reading_id") % 3 == 0, "soon").otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")))
    assert model.transform(text).count() == raw.where("reading_id % 3 <> 0").count()


def test_last_values_are_those_of_the_ordered_table(spark):
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [("a", t0 + dt.timedelta(minutes=m), m, None if m == 6 else float(m)) for m in (3, 1, 6, 2)] + [("b", t0, 1, 5.0), (None, t0, 1, 7.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, v double")
    for sizes in ({}, {"max_group_rows": 0, "segment_rows": 2}):
        got = {r["k"]: (r["seq"], r["lag1"], r["lag2"]) for r in state.last_values(df, "k", ["ts", "id"], "v", **sizes).collect()}
        assert got == {"a": (4, None, 3.0), "b": (1, 5.0, None), None: (1, 7.0, None)}


@pytest.mark.parametrize("files", [1, None])
def test_stream_predictions_are_those_of_the_whole_table(spark, raw, files):
    end = dt.datetime.fromisoformat(raw.agg(F.percentile_approx("timestamp", 0.7).cast("string")).first()[0])
    end = F.lit(end).cast("timestamp_ntz")
    history, coming = raw.where(F.col("timestamp") < end), raw.where(F.col("timestamp") >= end)
    model = fitted.Cleaning("energy").fit(history)
    past = materialize(model.transform(history))
    data = training.prepare(past, SPEC, ORDER, ["reading_id"])
    chosen = {"Decision Tree": training.models(SPEC.target)["Decision Tree"]}
    table, found, best = training.train_and_evaluate(data, SPEC.target, chosen)
    art = scoring.Artefacts.of(SPEC, data, best, found[best], table)
    names = ["reading_id", "lag_energy1", "lag_energy2", SPEC.prediction]
    want = scoring.score(model.transform(raw), art, ORDER).where(F.col("timestamp") >= end).select(*names)
    src, out, cp = (new_path(spark, x) for x in ("src", "out", "cp"))
    sent = coming.withColumn("timestamp", F.col("timestamp").cast("timestamp")).repartition(5, F.col("reading_id") % 17)
    sent.write.parquet(f"{src}/a")
    state.end_mark(sent, "timestamp").write.parquet(f"{src}/b")
    stream = read_files_as_stream(spark, f"{src}/*", sent.schema, max_files=files)
    scored = scoring.score_stream(stream, art, model, past, ORDER, wait=dt.timedelta(days=3650 - 1))
    jobs.finish(jobs.start_files(scored, out, cp), lossless=True)
    got = spark.read.parquet(out)
    assert not got.where("late").count() and got.count() == want.count() > 50
    assert got.select(*names).exceptAll(want).count() == 0


def test_duplicates_count_once_in_fitting(raw):
    one, two = (fitted.Cleaning("energy", exact=True).fit(x).statistics() for x in (raw, raw.unionByName(raw)))
    assert two["modes"] == one["modes"] and two["fences"] == {c: pytest.approx(v) for c, v in one["fences"].items()}
    assert cleaning.duplicate_count(raw).first()["n_duplicates"] == 0
