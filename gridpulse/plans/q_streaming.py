"""I-series and the streaming sources: streams over files derived from the whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridpulse.operators import cleaning, ordered
from gridpulse.plans.q_joins import ALIGNED_TABLES_SQL as ALIGNED_SQL
from gridpulse.plans.registry import query
from gridpulse.plans.views import Tables
from gridpulse.scratch import new_path
from gridpulse.sources import messages
from gridpulse.sources.rows import read_rows_as_stream
from gridpulse.streaming import jobs, state, summaries

ORDER = ["ts", "event_id"]


def zoned(df: DataFrame) -> DataFrame:
    """Watermarks need a timestamp with zone."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def plain(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, k in df.dtypes if k == "timestamp"})


def table_stream(t: Tables, name: str, max_files: int | None = None) -> DataFrame:
    """A given table, read as a stream of its files. The path is put as a pattern because
    the file source takes a single file only that way; it matches a folder as well."""
    path = t.path(name)
    return messages.read_files_as_stream(t.spark, f"{path[:-1]}[{path[-1]}]", t.table(name).schema, max_files=max_files)


def ends(df: DataFrame, by: str, parts: int) -> list:
    """First and last value of ``by`` and the ends of ``parts`` deliveries of about equal size between them."""
    probs = [i / parts for i in range(1, parts)]
    low, high, inner = df.agg(F.min(by), F.max(by), F.percentile_approx(by, probs, 1000) if probs else F.lit(None)).first()
    return [low, *(inner or []), high]


def longest(cuts: list) -> dt.timedelta:
    """No row of a delivery comes later than this after a row with a later time, however its files are dealt."""
    return max((b - a for a, b in zip(cuts, cuts[1:]) if a is not None), default=dt.timedelta()) + dt.timedelta(seconds=1)


def feed(t: Tables, df: DataFrame, label: str, start: Callable[[DataFrame], StreamingQuery], parts: int = 1, by: str = "ts",
         max_files: int | None = None, cuts: list | None = None, end: bool = False) -> None:
    """Hand ``df`` to a stream in ``parts`` successive deliveries in the order of ``by``, of ``max_files`` files a micro-batch.

    Each delivery is written in parallel and taken by one run of the query; the
    checkpoint carries offsets and state from run to run. ``end`` delivers an end mark after them.
    """
    path = new_path(t.spark, label)
    cuts = cuts or (ends(df, by, parts) if parts > 1 else [None, None])
    inner = [None, *cuts[1:-1], None]
    chunks = []
    for low, high in zip(inner, inner[1:]):
        chunk = df
        if low is not None:
            chunk = chunk.filter(F.col(by) > F.lit(low).cast(df.schema[by].dataType))
        if high is not None:
            chunk = chunk.filter(F.col(by) <= F.lit(high).cast(df.schema[by].dataType))
        chunks.append(chunk)
    if end:
        chunks.append(state.end_mark(df, by))
    for i, chunk in enumerate(chunks):
        chunk.write.parquet(f"{path}/p{i}")
        stream = messages.read_files_as_stream(t.spark, f"{path}/*", df.schema, max_files=max_files)
        jobs.finish(start(stream), lossless=True)


#: Rows of the longest stream in one micro-batch of streams that are joined.
STEP_ROWS = 2_000_000


def in_step(t: Tables, parts: list[tuple[DataFrame, str]], by: str, step_rows: int | None = None) -> list[DataFrame]:
    """Tables as streams in the order of ``by`` that come to their ends in the same number of micro-batches.

    What a join of them must keep is then about a micro-batch of each, not whole tables. No row comes later than one with a greater ``by``, so
    none is late for any watermark; how evenly they advance only decides how much is kept.
    """
    stored = []
    for df, label in parts:
        path = new_path(t.spark, label)
        # Small row groups: a task reads those that its rows lie in.
        df.repartitionByRange(by).sortWithinPartitions(by).write.option("parquet.block.size", 4 << 20).parquet(path)
        stored.append((path, t.spark.read.schema(df.schema).parquet(path).count()))
    steps = max(1, -(-max(n for _, n in stored) // (step_rows or STEP_ROWS)))
    cores = t.spark.sparkContext.defaultParallelism
    limits = [max(1, -(-n // steps)) for _, n in stored]
    return [read_rows_as_stream(t.spark, path, limit, max(10_000, -(-limit // cores))) for (path, _), limit in zip(stored, limits)]


def done(t: Tables, folder: str, schema=None) -> DataFrame:
    return t.spark.read.parquet(folder) if schema is None else t.spark.read.schema(schema).parquet(folder)


MESSAGE = "event_id bigint, user_id bigint, day_text string, value double"
CLEAN_SQL = """
    SELECT event_id, user_id, TRY_CAST(day_text AS TIMESTAMP) AS ts, value FROM dirty
    WHERE TRY_CAST(day_text AS TIMESTAMP) IS NOT NULL"""


def sent_messages(t: Tables) -> DataFrame:
    rows = t.dirty.select("event_id", "user_id", "day_text", F.nanvl("value", F.lit(None)).alias("value"))
    return messages.encode(rows, "user_id")


def decode_clean(t: Tables):
    schema = t.spark.createDataFrame([], MESSAGE).schema

    def run(batch: DataFrame) -> DataFrame:
        return cleaning.parse_time(messages.decode(batch, schema), "ts", "day_text").drop("day_text")

    return run


@query("a03_rate_limited_source", "SELECT count(*) AS n_rows, true AS one_file_per_batch FROM events")
def a03(t: Tables) -> DataFrame:
    src, out, cp = (new_path(t.spark, f"a03{x}") for x in ("src", "out", "cp"))
    rows = t.events.select("event_id", "ts")
    rows.write.parquet(src)
    stream = messages.read_files_as_stream(t.spark, src, rows.schema, max_files=1)
    jobs.finish(jobs.start_batches(stream, lambda b: b.withColumn("file", F.input_file_name()), out, cp, None))
    batches = done(t, out).groupBy("batch_id").agg(F.count("*").alias("n"), F.min("file").alias("a"), F.max("file").alias("b"))
    return batches.agg(F.sum("n").alias("n_rows"), F.bool_and(F.col("a") == F.col("b")).alias("one_file_per_batch"))


@query("a05_micro_batch_callback", CLEAN_SQL.replace("value FROM", "CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM"))
def a05(t: Tables) -> DataFrame:
    out, cp = new_path(t.spark, "a05out"), new_path(t.spark, "a05cp")
    feed(t, sent_messages(t), "a05", lambda s: jobs.start_batches(s, decode_clean(t), out, cp, None))
    return plain(done(t, out).drop("batch_id"))


@query("a06_timed_lifecycle", "SELECT count(*) AS n_rows FROM events")
def a06(t: Tables) -> DataFrame:
    out = new_path(t.spark, "a06out")
    stream = table_stream(t, "events").select("event_id", "ts")
    q = jobs.start_batches(stream, lambda b: b, out, new_path(t.spark, "a06cp"), "1 second")
    q.processAllAvailable()
    jobs.run_for([q], 0.1)
    return done(t, out).agg(F.count("*").alias("n_rows"))


@query("a03_rows_a_trigger", "SELECT event_id, user_id, ts, value FROM events")
def a03_rows(t: Tables) -> DataFrame:
    """The table as a stream that admits a fifth of its rows a micro-batch; the query stops once and goes on from its checkpoint."""
    out, cp = new_path(t.spark, "a03rows"), new_path(t.spark, "a03rowscp")
    limit = max(1, -(-t.events.count() // 5))
    columns = ["event_id", "user_id", "ts", "value"]

    def start() -> StreamingQuery:
        stream = read_rows_as_stream(t.spark, t.path("events"), limit).select(columns)
        return jobs.start_batches(stream, lambda b: b, out, cp, "0 seconds")

    for part in range(2):
        running = start()
        try:
            if part:
                running.processAllAvailable()
            else:
                running.awaitTermination(2)
        finally:
            running.stop()
    return jobs.read_committed(t.spark, out, t.events.select(columns).schema)


@query("i01_replay_from_start", "SELECT event_id, value FROM events")
def i01(t: Tables) -> DataFrame:
    stream = table_stream(t, "events", 1).select("event_id", "value")
    out = new_path(t.spark, "i01out")
    jobs.finish(jobs.start_files(stream, out, new_path(t.spark, "i01cp")))
    return done(t, out)


@query("i02_decode_clean_write", f"""
    SELECT user_id, count(*) AS n, count(value) AS n_values FROM (SELECT user_id, CASE WHEN isnan(value) THEN NULL ELSE value END
        AS value FROM ({CLEAN_SQL})) GROUP BY 1""")
def i02(t: Tables) -> DataFrame:
    out, cp = new_path(t.spark, "i02out"), new_path(t.spark, "i02cp")
    feed(t, sent_messages(t), "i02", lambda s: jobs.start_batches(s, decode_clean(t), out, cp, None))
    schema = t.spark.createDataFrame([], "event_id bigint, user_id bigint, value double, ts timestamp").schema
    rows = jobs.read_committed(t.spark, out, schema)
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count("value").alias("n_values"))


@query("i03_resume_after_restart", "SELECT event_id, ts, value FROM events")
def i03(t: Tables) -> DataFrame:
    """Two runs with one checkpoint: the second takes only what came after the first."""
    out, cp = new_path(t.spark, "i03out"), new_path(t.spark, "i03cp")
    rows = t.events.select("event_id", "ts", "value")
    feed(t, rows, "i03", lambda s: jobs.start_batches(s, lambda b: b, out, cp, None), 2)
    return done(t, out).drop("batch_id")


SERIES_SQL = """
    SELECT event_id, user_id, ts, value, row_number() OVER w AS seq, lag(value, 1) OVER w AS lag1, lag(value, 2) OVER w AS lag2,
        false AS late FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


def series(t: Tables, label: str, parts: int, seed: float = 0.0, max_files: int | None = None) -> DataFrame:
    rows = zoned(t.events.select("event_id", "user_id", "ts", "value"))
    out, cp = new_path(t.spark, f"{label}out"), new_path(t.spark, f"{label}cp")
    cuts = ends(rows, "ts", parts)

    def start(stream: DataFrame) -> StreamingQuery:
        return jobs.start_files(state.with_series_state(stream, "user_id", ORDER, "value", 0.32, seed, wait=longest(cuts)), out, cp)

    feed(t, rows, label, start, parts, max_files=max_files, cuts=cuts, end=True)
    return plain(done(t, out))


@query("i04_stream_lags", SERIES_SQL)
def i04(t: Tables) -> DataFrame:
    return series(t, "i04", 3).drop("smooth")


@query("i04_stream_lags_carried", SERIES_SQL.replace("row_number() OVER w AS seq, ", "").replace("user_id", "event_type")
       .replace(",\n        false AS late", ""))
def i04_carried(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "ts", "value")
    out, cp = new_path(t.spark, "i04cout"), new_path(t.spark, "i04ccp")
    lags = jobs.CarriedLags("event_type", ORDER, "value", out, new_path(t.spark, "i04cstate"))
    feed(t, rows, "i04c", lambda s: jobs.start_carried_lags(s, lags, cp), 2)
    return done(t, out).drop("batch_id", "late")


@query("i04_zero_fill_lags", "SELECT event_id, value, 0::DOUBLE AS lag1, 0::DOUBLE AS lag2 FROM events")
def i04_zero(t: Tables) -> DataFrame:
    stream = table_stream(t, "events").select("event_id", "value")
    out = new_path(t.spark, "i04zout")
    zero = stream.withColumns({"lag1": F.lit(0.0), "lag2": F.lit(0.0)})
    jobs.finish(jobs.start_files(zero, out, new_path(t.spark, "i04zcp")))
    return done(t, out)


def smooth_sql(key: str, seed: float) -> str:
    return f"""
    SELECT event_id, {key}, smooth FROM (
        WITH RECURSIVE r AS (SELECT event_id, {key}, value, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS rn FROM events),
        s AS (SELECT event_id, {key}, rn, 0.68::DOUBLE * {seed} + 0.32::DOUBLE * value AS smooth FROM r WHERE rn = 1
              UNION ALL SELECT r.event_id, r.{key}, r.rn, 0.68::DOUBLE * s.smooth + 0.32::DOUBLE * r.value FROM s JOIN r
                  ON r.{key} = s.{key} AND r.rn = s.rn + 1)
        SELECT * FROM s)"""


@query("i05_smoothing_batch", smooth_sql("user_id", 4000), rounded="smooth")
def i05(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", "value")
    frame = ordered.OrderedFrame.of(rows, ["user_id"], ORDER).smooth("value", "smooth", 0.32, 4000.0)
    return frame.result().select("event_id", "user_id", "smooth")


@query("i05_smoothing_split_keys", smooth_sql("event_type", 100), rounded="smooth")
def i05_split(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "ts", "value")
    frame = ordered.OrderedFrame.of(rows, ["event_type"], ORDER, max_group_rows=0, segment_rows=2_000)
    return frame.smooth("value", "smooth", 0.32, 100.0).result().select("event_id", "event_type", "smooth")


@query("i05_smoothing_stream", smooth_sql("user_id", 100), rounded="smooth")
def i05_stream(t: Tables) -> DataFrame:
    return series(t, "i05", 2, 100.0).select("event_id", "user_id", "smooth")


@query("i06_event_time_order", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events")
def i06(t: Tables) -> DataFrame:
    return series(t, "i06", 1).select("event_id", "user_id", "seq")


def measures() -> dict[str, Column]:
    return {"n": F.count("*"), "mean_value": F.avg("value"), "max_value": F.max("value")}


@query("i07_windowed_kpis", """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
        event_type, count(*) AS n, avg(value) AS mean_value, max(value) AS max_value FROM events GROUP BY 1, 2, 3""",
    rounded="mean_value")
def i07(t: Tables) -> DataFrame:
    out, cp = new_path(t.spark, "i07out"), new_path(t.spark, "i07cp")
    rows = zoned(t.events.select("ts", "event_type", "value"))

    def start(stream: DataFrame) -> StreamingQuery:
        kpis = jobs.windowed_kpis(stream, "ts", measures(), "1 hour", "1 hour", keys=["event_type"])
        return jobs.start_refreshed_table(kpis, out, cp)

    feed(t, rows, "i07", start, 2)
    return plain(done(t, out))


@query("i07_sliding_kpis", """
    SELECT s AS window_start, s + INTERVAL 2 HOUR AS window_end, count(*) AS n, avg(value) AS mean_value, max(value) AS max_value
    FROM (SELECT value, unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS s FROM events)
    GROUP BY 1, 2""", rounded="mean_value")
def i07_sliding(t: Tables) -> DataFrame:
    out = new_path(t.spark, "i07sout")
    kpis = jobs.windowed_kpis(zoned(table_stream(t, "events")), "ts", measures(), "2 hours", "1 hour", "1 hour")
    jobs.finish(jobs.start_refreshed_table(kpis, out, new_path(t.spark, "i07scp")))
    return plain(done(t, out))


@query("i08_stream_deduplication", "SELECT event_id, user_id, ts FROM dirty")
def i08(t: Tables) -> DataFrame:
    out, cp = new_path(t.spark, "i08out"), new_path(t.spark, "i08cp")
    rows = zoned(t.repeated.select("event_id", "user_id", "ts"))
    cuts = ends(rows, "ts", 2)

    def start(stream: DataFrame) -> StreamingQuery:
        late = f"{int(longest(cuts).total_seconds())} seconds"
        return jobs.start_files(jobs.drop_stream_duplicates(stream, "ts", ["event_id", "ts"], late), out, cp)

    feed(t, rows, "i08", start, 2, cuts=cuts)
    return plain(done(t, out))


@query("c09_align_streams", """
    SELECT area, timestamp, t.v AS vehicle_count, e.k AS energy_consumption, p.q AS "AQI"
    FROM (SELECT area, timestamp, temperature AS v FROM energy) t
    JOIN (SELECT area, timestamp, energy_consumption AS k FROM energy WHERE load_type <> 'Industrial') e USING (area, timestamp)
    JOIN (SELECT area, timestamp, humidity AS q FROM energy WHERE weather <> 'Rain') p USING (area, timestamp)""")
def c09_streams(t: Tables) -> DataFrame:
    parts = [
        (t.energy.select("area", "timestamp", F.col("temperature").alias("vehicle_count")), "c09t"),
        (t.energy.filter("load_type <> 'Industrial'").select("area", "timestamp", "energy_consumption"), "c09e"),
        (t.energy.filter("weather <> 'Rain'").select("area", "timestamp", F.col("humidity").alias("AQI")), "c09p"),
    ]
    streams = [df.withColumn("timestamp", F.col("timestamp").cast("timestamp")) for df in in_step(t, parts, "timestamp")]
    joined = jobs.join_streams(streams, "timestamp", "area", "1 hour")
    out = new_path(t.spark, "c09out")
    jobs.drain(jobs.start_files(joined, out, new_path(t.spark, "c09cp"), interval="0 seconds"), lossless=True)
    return plain(done(t, out, joined.schema))


@query("c09_align_tables_stream", ALIGNED_SQL, rounded="vehicle_count energy_consumption AQI")
def c09_tables_stream(t: Tables) -> DataFrame:
    """The three tables whole as three streams of several files, aligned by calendar day by one state row for each day."""
    day = F.make_timestamp(F.lit(2000), F.month("timestamp"), F.dayofmonth("timestamp"), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    streams = {}
    for table, value in (("traffic", "vehicle_count"), ("energy", "energy_consumption"), ("pollution", "AQI")):
        rows = getattr(t, table).select(F.month("timestamp").alias("month"), F.dayofmonth("timestamp").alias("day"), day.alias("slot"), value)
        path = new_path(t.spark, f"c09-{table}")
        rows.repartition(3).write.parquet(f"{path}/a")
        state.end_mark(rows, "slot").write.parquet(f"{path}/b")
        streams[value] = messages.read_files_as_stream(t.spark, f"{path}/*", rows.schema, max_files=2)
    out = new_path(t.spark, "c09s-out")
    aligned = state.align_on_stream(streams, ["month", "day"], "slot", hold=dt.timedelta(days=367))
    jobs.finish(jobs.start_files(aligned, out, new_path(t.spark, "c09s-cp")), lossless=True)
    return done(t, out, aligned.schema)


@query("i07_stored_summaries", """
    SELECT event_type, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS std, avg(v) - stddev_samp(v) AS band_low, avg(v) + stddev_samp(v) AS band_high,
        stddev_samp(v) / avg(v) AS cv, min(v) AS low, max(v) AS high, true AS quartiles_within_rank_error
    FROM (SELECT event_type, CASE WHEN NOT isnan(value) THEN value END AS v FROM dirty) GROUP BY event_type""",
    rounded="mean std band_low band_high cv", digits=5)
def i07_summaries(t: Tables) -> DataFrame:
    """Figures of the whole stream from stored summaries of its micro-batches, which are merged on the way."""
    rows = t.dirty.select("ts", "event_type", "value")
    table = summaries.Summaries(new_path(t.spark, "i07sum"), StructType([rows.schema["event_type"]]), ["value"], every=3)
    cp = new_path(t.spark, "i07sum-cp")
    feed(t, rows, "i07sum", lambda s: summaries.start_summaries(s, table, cp), 5, max_files=1)
    found = summaries.figures(table.read(t.spark), ["event_type"])
    # The sketch's quartiles must lie between the exact quantiles three percent around them.
    around = [0.22, 0.28, 0.47, 0.53, 0.72, 0.78]
    exact = rows.groupBy("event_type").agg(F.percentile(F.nanvl("value", F.lit(None)), around).alias("around"))
    joined = found.join(exact, found["event_type"].eqNullSafe(exact["event_type"])).drop(exact["event_type"])
    near = F.lit(True)
    for i, q in enumerate(("q25", "q50", "q75")):
        near = near & F.col(q).between(F.col("around")[2 * i], F.col("around")[2 * i + 1])
    return joined.select("event_type", "n", "mean", "std", "band_low", "band_high", "cv", "low", "high", near.alias("quartiles_within_rank_error"))
