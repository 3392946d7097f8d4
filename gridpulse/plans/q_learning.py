"""J-series: encoding, scaling, training, validation, importances, scoring."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.learning import fitted, prepare, scoring, training
from gridpulse.operators.ordered import lag_features
from gridpulse.plans import q_streaming
from gridpulse.plans.registry import query
from gridpulse.plans.views import Tables
from gridpulse.schemas import DATASETS
from gridpulse.scratch import materialize, new_path
from gridpulse.sources import files, messages
from gridpulse.streaming import jobs, state

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
ORDER = {"traffic": ["timestamp", "order_no", "part_no", "supp_no", "line_no"],
         "energy": ["timestamp", "reading_id"], "pollution": ["timestamp", "reading_id"]}


@query("j01_string_index", """
    SELECT weather, (row_number() OVER (ORDER BY count(*) DESC, weather) - 1)::DOUBLE AS weather_idx, count(*) AS n
    FROM traffic GROUP BY weather""")
def j01(t: Tables) -> DataFrame:
    rows = t.traffic.select("weather")
    return training.encoder(["weather"]).fit(rows).transform(rows).groupBy("weather", "weather_idx").agg(
        F.count("*").alias("n"))


@query("j02_one_hot", """
    SELECT zone, row_number() OVER (ORDER BY count(*) DESC, zone) AS slot, CAST(count(*) OVER () AS INT) AS size, count(*) AS n
    FROM energy GROUP BY zone""")
def j02(t: Tables) -> DataFrame:
    rows = t.energy.select("zone")
    hot = vector_to_array("zone_ohe")
    coded = training.encoder(["zone"]).fit(rows).transform(rows).select(
        "zone", F.array_position(hot, 1.0).alias("slot"), F.size(hot).alias("size"))
    return coded.groupBy("zone", "slot", "size").agg(F.count("*").alias("n"))


@query("j03_scale_by_deviation", "SELECT " + ", ".join(KEYS) + ", " + ", ".join(
    f"{c} / (SELECT stddev_samp({c}) FROM lineitem) AS {c}" for c in NUMERIC) + " FROM lineitem", rounded=" ".join(NUMERIC))
def j03(t: Tables) -> DataFrame:
    rows = t.lineitem.select(*KEYS, *NUMERIC)
    scaled = training.scaler(NUMERIC).fit(rows).transform(rows).withColumn("v", vector_to_array("num_scaled"))
    return scaled.select(*KEYS, *[F.col("v")[i].alias(c) for i, c in enumerate(NUMERIC)])


@query("j04_assembled_vector", "SELECT * FROM (WITH z AS (SELECT DISTINCT zone, row_number() OVER (ORDER BY n DESC, zone) AS i FROM "
       "(SELECT zone, count(*) AS n FROM energy GROUP BY zone)) "
       "SELECT 0 AS slot, avg(temperature) / stddev_samp(temperature) AS mean FROM energy "
       "UNION ALL SELECT 1, avg(humidity) / stddev_samp(humidity) FROM energy "
       "UNION ALL SELECT CAST(1 + i AS INT), avg(CAST(e.zone = z.zone AS INT)) FROM energy e CROSS JOIN z GROUP BY i "
       "UNION ALL SELECT 7, avg(is_it_hub) FROM energy)", rounded="mean")
def j04(t: Tables) -> DataFrame:
    rows = t.energy.select("temperature", "humidity", "zone", "is_it_hub")
    steps = Pipeline(stages=[
        training.encoder(["zone"]),
        VectorAssembler(inputCols=["temperature", "humidity"], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=False),
        VectorAssembler(inputCols=["scaled", "zone_ohe", "is_it_hub"], outputCol="features"),
    ])
    vectors = steps.fit(rows).transform(rows).select(F.posexplode(vector_to_array("features")).alias("slot", "x"))
    return vectors.groupBy("slot").agg(F.avg("x").alias("mean"))


@query("j05_linear_regression", """
    SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept,
        regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem""", rounded="slope intercept r2", digits=3)
def j05(t: Tables) -> DataFrame:
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        t.lineitem.select("l_quantity", "l_extendedprice"))
    model = LinearRegression(labelCol="l_extendedprice", featuresCol="features", maxIter=100).fit(rows)
    fitted = training.scored(model, rows, "l_extendedprice")
    return fitted.select(F.lit(float(model.coefficients[0])).alias("slope"),
                         F.lit(float(model.intercept)).alias("intercept"), "r2")


def cleaned(t: Tables, name: str) -> DataFrame:
    return materialize(prepare.clean(getattr(t, name), DATASETS[name]), "cleaned")


def ready(t: Tables, name: str, rows: DataFrame | None = None) -> training.Prepared:
    spec = DATASETS[name]
    rows = prepare.clean(getattr(t, name), spec) if rows is None else rows
    # the fixture's row keys order rows with equal times; they are no features
    return training.prepare(rows, spec, ORDER[name], ignore=[c for c in ORDER[name] if c != "timestamp"])


def only(target: str, *names: str):
    return {n: m for n, m in training.models(target).items() if n in names}


for _id, _model in (("j06_decision_tree", "Decision Tree"), ("j07_random_forest", "Random Forest"),
                    ("j08_gradient_boosting", "Gradient Boosting")):
    @query(_id)
    def _tree(t: Tables, model: str = _model) -> DataFrame:
        return training.train_and_evaluate(ready(t, "energy"), "energy_consumption", only("energy_consumption", model))[0]


for _id, _model, _exact in (("j06_tree_group_means", "Decision Tree", {}),
                            ("j07_forest_group_means", "Random Forest", {"bootstrap": False, "featureSubsetStrategy": "all", "numTrees": 4}),
                            ("j08_boosting_group_means", "Gradient Boosting", {"subsamplingRate": 1.0, "maxIter": 3})):
    # With a leaf for each value of the only feature and no sampling, each model predicts the means of the groups.
    @query(_id, """
        SELECT l_linenumber, avg(l_quantity + 10 * l_linenumber) AS prediction, 1.0::DOUBLE AS importance
        FROM lineitem GROUP BY l_linenumber""", rounded="prediction importance", digits=5)
    def _means(t: Tables, model: str = _model, exact: dict = _exact) -> DataFrame:
        rows = t.lineitem.select("l_linenumber", (F.col("l_quantity") + 10 * F.col("l_linenumber")).alias("y"))
        vectors = VectorAssembler(inputCols=["l_linenumber"], outputCol="features")
        estimator = training.models("y")[model]
        fitted = estimator.copy({estimator.getParam(k): v for k, v in exact.items()}).fit(vectors.transform(training.spread(rows)))
        found = fitted.transform(vectors.transform(rows)).groupBy("l_linenumber").agg(F.avg("prediction").alias("prediction"))
        return found.withColumn("importance", F.lit(float(fitted.featureImportances[0])))


@query("j09_train_and_select")
def j09(t: Tables) -> DataFrame:
    table, _, best = training.train_and_evaluate(ready(t, "energy"), "energy_consumption")
    return table.withColumn("best", F.col("model") == best)


@query("j10_cross_validation")
def j10(t: Tables) -> DataFrame:
    chosen = training.models("AQI")
    data = ready(t, "pollution")
    _, fitted, _ = training.train_and_evaluate(data, "AQI", chosen)
    return training.cross_validation(data, "AQI", fitted, chosen, folds=3)


@query("j11_fit_status", """
    SELECT event_id, CASE WHEN a > 0.9 AND a - c > 0.08 THEN 'Overfitting' WHEN a < 0.75 AND c < 0.75 THEN 'Underfitting'
        WHEN abs(b - c) > 0.05 THEN 'Unstable' ELSE 'Good Fit' END AS status
    FROM (SELECT event_id, 0.5::DOUBLE + (event_id % 50) / 100::DOUBLE AS a, 0.5::DOUBLE + (user_id % 50) / 100::DOUBLE AS b,
        0.5::DOUBLE + least(value, 49) / 100::DOUBLE AS c FROM events)""")
def j11(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id", (0.5 + (F.col("event_id") % 50) / 100.0).alias("a"), (0.5 + (F.col("user_id") % 50) / 100.0).alias("b"),
        (0.5 + F.least("value", F.lit(49.0)) / 100.0).alias("c"))
    return rows.select("event_id", training.fit_status(F.col("a"), F.col("b"), F.col("c")).alias("status"))


@query("j12_feature_importances")
def j12(t: Tables) -> DataFrame:
    data = ready(t, "energy")
    _, fitted, best = training.train_and_evaluate(data, "energy_consumption", only("energy_consumption", "Decision Tree"))
    return training.importances(fitted[best], data.feature_names, data.train)


@query("f07_leading_importances")
def f07(t: Tables) -> DataFrame:
    data = ready(t, "traffic")
    _, fitted, best = training.train_and_evaluate(data, "vehicle_count", only("vehicle_count", "Decision Tree"))
    return training.importances(fitted[best], data.feature_names, data.train, 15)


def trained(t: Tables, name: str, rows: DataFrame | None = None) -> scoring.Artefacts:
    spec, data = DATASETS[name], ready(t, name, rows)
    table, fitted, best = training.train_and_evaluate(data, spec.target, only(spec.target, "Decision Tree"))
    return scoring.Artefacts.of(spec, data, best, fitted[best], table)


for _name in DATASETS:
    @query(f"j13_score_{_name}", f"SELECT count(*) AS n_rows, 0::BIGINT AS n_without_prediction, 0::BIGINT AS n_without_area FROM {_name}")
    def _score(t: Tables, name: str = _name) -> DataFrame:
        rows = cleaned(t, name)
        art = trained(t, name, rows)
        out = scoring.score(rows, art, ORDER[name])
        p = F.col(art.spec.prediction)
        return out.agg(F.count("*").alias("n_rows"), F.count_if(p.isNull() | F.isnan(p)).alias("n_without_prediction"),
                       F.count_if(F.col("area").isNull()).alias("n_without_area"))


@query("j14_clean_and_score", """
    SELECT zone, count(*) AS n_rows, avg(is_it_hub) AS hub_share FROM energy GROUP BY zone""", rounded="hub_share")
def j14(t: Tables) -> DataFrame:
    """Raw table with repeated rows through clean and score; repeated rows must be gone."""
    art = trained(t, "energy")
    raw = t.energy.unionByName(t.energy.filter("zone = 'East'"))
    out = scoring.clean_and_score(raw, art, ORDER["energy"]).filter(F.col(art.spec.prediction).isNotNull())
    return out.groupBy("zone").agg(F.count("*").alias("n_rows"), F.avg("is_it_hub").alias("hub_share"))


@query("j14_clean_and_score_stream", "SELECT reading_id, area FROM energy")
def j14_stream(t: Tables) -> DataFrame:
    """Keyed JSON messages, decoded, cleaned and scored per micro-batch (lags 0, as without history)."""
    art = trained(t, "energy")
    rows = t.energy.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    rows = rows.drop("hour", "day", "dayofweek", "month", "year")
    src, out = new_path(t.spark, "j14src"), new_path(t.spark, "j14out")
    encoded = messages.encode(rows, "area")
    encoded.write.parquet(f"{src}/p0")
    stream = messages.read_files_as_stream(t.spark, f"{src}/*", encoded.schema)
    scorer = scoring.batch_scorer(art, lambda b: messages.decode(b, rows.schema))
    jobs.finish(jobs.start_batches(stream, scorer, out, new_path(t.spark, "j14cp"), None))
    return t.spark.read.parquet(out).filter(F.col(art.spec.prediction).isNotNull()).select("reading_id", "area")


def gappy(t: Tables) -> DataFrame:
    return t.energy.withColumn("energy_consumption", F.when(F.col("reading_id") % 19 != 0, F.col("energy_consumption")))


def history_end(rows: DataFrame) -> dt.datetime:
    """Four fifths of the time that the table covers."""
    low, high = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    return low + dt.timedelta(microseconds=(high - low) // dt.timedelta(microseconds=1) * 4 // 5)


LAG_BUCKET = "least(floor({} / 1500), 4)"


@query("j14_seeded_stream", f"""
    WITH raw AS (SELECT reading_id, area, timestamp, CASE WHEN reading_id % 19 <> 0 THEN energy_consumption END AS e FROM energy),
    cut AS (SELECT make_timestamp(min(epoch_us(timestamp)) + (max(epoch_us(timestamp)) - min(epoch_us(timestamp))) * 4 // 5) AS c FROM raw),
    h AS (SELECT raw.* FROM raw, cut WHERE timestamp < c),
    m AS (SELECT avg(e) AS m FROM h),
    f AS (SELECT quantile_cont(coalesce(e, m), 0.25) AS q1, quantile_cont(coalesce(e, m), 0.75) AS q3 FROM h, m),
    cleaned AS (SELECT reading_id, area, timestamp, greatest(least(coalesce(e, m), q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) AS v FROM raw, m, f),
    lagged AS (SELECT *, coalesce(lag(v, 1) OVER w, 0) AS lag1, coalesce(lag(v, 2) OVER w, 0) AS lag2 FROM cleaned
        WINDOW w AS (PARTITION BY area ORDER BY timestamp, reading_id)),
    placed AS (SELECT *, {LAG_BUCKET.format('lag1')} AS b FROM lagged),
    means AS (SELECT b, avg(v) AS prediction FROM placed, cut WHERE timestamp < c GROUP BY b)
    SELECT reading_id, area, v AS energy_consumption, lag1, lag2, prediction, false AS late
    FROM placed JOIN means USING (b), cut WHERE timestamp >= c""", rounded="energy_consumption lag1 lag2 prediction", digits=5)
def j14_seeded(t: Tables) -> DataFrame:
    """Cleaning fitted on the history, lags that go on from its last readings, a tree whose leaves are the lag's buckets: all of it on a stream."""
    order, rows = ["timestamp", "reading_id"], gappy(t)
    end = history_end(rows)
    history = rows.filter(F.col("timestamp") < F.lit(end).cast("timestamp_ntz"))
    model = fitted.Cleaning("energy", exact=True).fit(history)
    past = materialize(model.transform(history).withColumn("timestamp", F.col("timestamp").cast("timestamp")), "past")

    def features(df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=["bucket"], outputCol="features").transform(
            df.withColumn("bucket", F.expr(LAG_BUCKET.format("lag1")).cast("double")))

    lagged = lag_features(past, "area", order, "energy_consumption", {"lag1": 1})
    tree = training.models("energy_consumption")["Decision Tree"].fit(features(lagged))
    coming = rows.filter(F.col("timestamp") >= F.lit(end).cast("timestamp_ntz")).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    first = state.last_values(past, "area", order, "energy_consumption")
    cuts, out, cp = q_streaming.ends(coming, "timestamp", 2), new_path(t.spark, "j14s-out"), new_path(t.spark, "j14s-cp")

    def start(stream: DataFrame):
        series = state.with_series_state(model.transform(stream), "area", order, "energy_consumption", wait=q_streaming.longest(cuts), first=first)
        filled = series.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("lag1", "lag2")})
        scored = tree.transform(features(filled)).select("reading_id", "area", "energy_consumption", "lag1", "lag2", "prediction", "late")
        return jobs.start_files(scored, out, cp)

    q_streaming.feed(t, coming, "j14s", start, 2, by="timestamp", cuts=cuts, max_files=1, end=True)
    return t.spark.read.parquet(out)


@query("j15_model_comparison")
def j15(t: Tables) -> DataFrame:
    def compared(name: str) -> DataFrame:
        table, _, best = training.train_and_evaluate(ready(t, name), DATASETS[name].target)
        return table.select(F.lit(name).alias("dataset"), "model", "rmse", "mae", "mse", "r2", (F.col("model") == best).alias("best"))

    tables = training.at_once(t.spark, [lambda name=name: compared(name) for name in DATASETS])
    return reduce(DataFrame.unionByName, tables)


@query("a16_model_save_and_load", "SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM pollution")
def a16(t: Tables) -> DataFrame:
    rows = cleaned(t, "pollution")
    art = trained(t, "pollution", rows)
    folder = new_path(t.spark, "a16")
    art.save(folder)
    again = scoring.Artefacts.load(t.spark, folder)
    a = scoring.score(rows, art).select("reading_id", F.col("predicted_AQI").alias("a"))
    b = scoring.score(rows, again).select("reading_id", F.col("predicted_AQI").alias("b"))
    return a.join(b, "reading_id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("a") != F.col("b")).alias("n_different"))


@query("a13_metrics_sink")
def a13_model(t: Tables) -> DataFrame:
    path = new_path(t.spark, "a13")
    table = trained(t, "energy").metrics_table()
    files.write_metrics(table, path)
    return files.read_json_document(t.spark, path, files.metrics_rows(table).schema)
