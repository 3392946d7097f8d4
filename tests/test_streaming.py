"""Streams: one file or many, late rows, restart, replay of a batch."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.plans import q_streaming
from gridpulse.plans.views import Tables
from gridpulse.scratch import new_path
from gridpulse.sources import files
from gridpulse.sources.messages import decode, encode, kafka_options, read_files_as_stream
from gridpulse.streaming import jobs, state

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def rows(*items):
    return [(k, T0 + dt.timedelta(minutes=m), i, v) for i, (k, m, v) in enumerate(items)]


SCHEMA = "k string, ts timestamp, id int, v double"


def series(spark, *parts, wait=1, end=True):
    """Each part is one run of the query, so state and watermark go over from batch to batch."""
    src, out, cp = (new_path(spark, x) for x in ("src", "out", "cp"))
    frames = [spark.createDataFrame(rows(*p), SCHEMA) for p in parts]
    if end:
        frames.append(state.end_mark(frames[0], "ts"))
    for i, df in enumerate(frames):
        df.coalesce(1).write.parquet(f"{src}/p{i}")
        stream = read_files_as_stream(spark, f"{src}/*", frames[0].schema)
        result = state.with_series_state(stream, "k", ["ts", "id"], "v", 0.5, 0.0, wait=dt.timedelta(minutes=wait))
        jobs.finish(jobs.start_files(result, out, cp), lossless=True)
    return spark.read.schema(result.schema).parquet(out).orderBy("k", "ts", "id").collect()


def test_lags_cross_micro_batches(spark):
    got = series(spark, [("a", 2, 2.0), ("a", 1, 1.0), ("b", 1, 9.0)], [("a", 3, 3.0), ("a", 4, 4.0)])
    a = [r for r in got if r["k"] == "a"]
    assert [r["seq"] for r in a] == [1, 2, 3, 4]
    assert [r["lag1"] for r in a] == [None, 1.0, 2.0, 3.0]
    assert [r["lag2"] for r in a] == [None, None, 1.0, 2.0]
    assert [r["smooth"] for r in a] == [0.5, 1.25, 2.125, 3.0625]


def test_rows_wait_for_earlier_ones(spark):
    got = series(spark, [("a", 10, 1.0)], [("a", 5, 7.0), ("a", 11, 2.0)], [("a", 12, 3.0)], wait=6)
    assert [(r["v"], r["seq"], r["lag1"], r["late"]) for r in got] == [
        (7.0, 1, None, False), (1.0, 2, 7.0, False), (2.0, 3, 1.0, False), (3.0, 4, 2.0, False)]


def test_late_row_is_kept_and_marked(spark):
    got = series(spark, [("a", 10, 1.0)], [("b", 20, 9.0)], [("a", 5, 7.0), ("a", 11, 2.0)], [("a", 12, 3.0)])
    by_value = {r["v"]: r for r in got}
    assert len(got) == 5
    assert by_value[7.0]["late"] and by_value[7.0]["lag1"] is None and by_value[7.0]["seq"] is None
    assert (by_value[2.0]["lag1"], by_value[3.0]["lag1"], by_value[3.0]["lag2"]) == (1.0, 2.0, 1.0)
    assert not by_value[2.0]["late"]


def test_idle_key_leaves_when_others_move_the_clock(spark):
    got = series(spark, [("a", 1, 1.0)], [("b", 30, 2.0)], end=False)
    assert [(r["k"], r["v"]) for r in got] == [("a", 1.0)]  # b waits until the stream is past it


def test_equal_times_are_not_late(spark):
    got = series(spark, [("a", 1, 1.0)], [("a", 1, 2.0)])
    assert [(r["late"], r["seq"]) for r in got] == [(False, 1), (False, 2)]


def test_missing_values_and_a_missing_key(spark):
    got = series(spark, [("a", 1, 1.0), (None, 1, 5.0)], [("a", 2, None), (None, 2, 6.0)], [("a", 3, 3.0)])
    assert [(r["k"], r["v"], r["lag1"], r["lag2"], r["smooth"]) for r in got] == [
        (None, 5.0, None, None, 2.5), (None, 6.0, 5.0, None, 4.25),
        ("a", 1.0, None, None, 0.5), ("a", None, 1.0, None, 0.5), ("a", 3.0, None, 1.0, 1.75)]


def test_order_does_not_hang_on_micro_batches(spark):
    """Rows up to 30 minutes out of order, one key with nine tenths of them, over 24 files: 1, 5 or all files a trigger give the same."""
    draw = random.Random(3)
    items = sorted(((draw.random() * 600, "hot" if draw.random() < 0.9 else f"k{draw.randrange(5)}") for _ in range(1200)))
    table = [(k, T0 + dt.timedelta(minutes=m), i, None if i % 17 == 0 else float(i % 13)) for i, (m, k) in enumerate(items)]
    sent = sorted(table, key=lambda r: r[1] + dt.timedelta(minutes=29 * draw.random()))
    src, schema = new_path(spark, "src"), spark.createDataFrame([], SCHEMA).schema
    for i in range(24):
        spark.createDataFrame(sent[50 * i: 50 * i + 50], schema).coalesce(1).write.parquet(f"{src}/p{i:02}")
    state.end_mark(spark.createDataFrame([], schema), "ts").coalesce(1).write.parquet(f"{src}/p24")
    want, last, smooth = [], {}, {}
    for k, ts, i, v in table:
        held = last.setdefault(k, [])
        smooth[k] = smooth.get(k, 0.0) if v is None else 0.5 * smooth.get(k, 0.0) + 0.5 * v
        lag = [None, None, *held][-2:]
        want.append((i, k, len(held) + 1, lag[1], lag[0], round(smooth[k], 9), False))
        held.append(v)
    for files in (1, 5, None):
        out, cp = new_path(spark, "out"), new_path(spark, "cp")
        stream = read_files_as_stream(spark, f"{src}/*", schema, max_files=files)
        result = state.with_series_state(stream, "k", ["ts", "id"], "v", 0.5, 0.0, wait=dt.timedelta(minutes=30))
        jobs.finish(jobs.start_files(result, out, cp), lossless=True)
        got = spark.read.schema(result.schema).parquet(out).orderBy("id").collect()
        assert [(r["id"], r["k"], r["seq"], r["lag1"], r["lag2"], round(r["smooth"], 9), r["late"]) for r in got] == want


def test_affine_scan_against_a_loop():
    values = np.array([1.0, np.nan, 3.0, np.nan, np.nan, 5.0, -2.0])
    state_, want = 7.0, []
    for x in values:
        state_ = state_ if np.isnan(x) else 0.7 * state_ + 0.3 * x
        want.append(state_)
    assert np.allclose(state.affine_scan(values, 0.3, 7.0), want)
    assert len(state.affine_scan(np.array([]), 0.3, 7.0)) == 0


def test_rows_left_out_as_too_late_are_an_error(spark):
    src, out, cp = (new_path(spark, x) for x in ("src", "out", "cp"))
    for i, minute in enumerate((500, 1)):
        spark.createDataFrame(rows(("a", minute, 1.0)), SCHEMA).coalesce(1).write.parquet(f"{src}/p{i}")
        stream = read_files_as_stream(spark, f"{src}/*", spark.createDataFrame([], SCHEMA).schema)
        query = jobs.start_files(jobs.drop_stream_duplicates(stream, "ts", ["k", "ts"], "1 hour"), out, cp)
        if i:
            with pytest.raises(RuntimeError, match="1 rows"):
                jobs.finish(query, lossless=True)
        else:
            jobs.finish(query, lossless=True)


def test_replayed_batch_replaces_itself(spark):
    folder = new_path(spark, "replay")
    write = jobs.batch_writer(lambda b: b, folder)
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(0), 1)
    assert spark.read.parquet(folder).count() == 5


def test_a_batch_that_fails_halfway_is_not_seen_and_is_replaced(spark):
    folder, schema = new_path(spark, "sink"), spark.range(1).schema
    assert jobs.read_committed(spark, folder, schema).count() == 0
    write = jobs.batch_writer(lambda b: b, folder)
    write(spark.range(5), 0)
    spark.range(100, 103).write.parquet(f"{folder}/batch_id=1")  # written, but its mark is missing
    assert jobs.read_committed(spark, folder, schema).count() == 5 and jobs.committed(spark, folder) == 0
    fails = jobs.batch_writer(lambda b: b.select(F.assert_true(F.col("id") != 7).alias("x"), "id"), folder)
    with pytest.raises(Exception, match="is not true"):
        fails(spark.range(6, 10), 1)
    assert jobs.read_committed(spark, folder, schema).count() == 5
    write(spark.range(6, 10), 1)
    write(spark.range(6, 10), 1)  # a replay
    for i in range(2, 6):
        write(spark.range(1), i)
    got = jobs.read_committed(spark, folder, schema)
    assert got.columns == ["id"] and got.count() == 5 + 4 + 4 and jobs.committed(spark, folder) == 5
    assert len([f for f in files.children(spark, f"{folder}/_committed") if f.isdigit()]) == 2


def test_carried_state_keeps_two_folders(spark):
    out, kept = new_path(spark, "tout"), new_path(spark, "tstate")
    lags = jobs.CarriedLags("k", ["ts", "id"], "v", out, kept)
    for i in range(5):
        lags(spark.createDataFrame([("a", T0 + dt.timedelta(minutes=i), i, float(i))], SCHEMA), i)
    assert sorted(n for n in files.children(spark, kept) if n.startswith("batch")) == ["batch_id=3", "batch_id=4"]
    lags(spark.createDataFrame([("a", T0 + dt.timedelta(minutes=4), 4, 4.0)], SCHEMA), 4)
    got = spark.read.parquet(out).orderBy("ts").collect()
    assert [(r["v"], r["lag1"], r["lag2"]) for r in got] == [
        (0.0, None, None), (1.0, 0.0, None), (2.0, 1.0, 0.0), (3.0, 2.0, 1.0), (4.0, 3.0, 2.0)]


def test_carried_lags_replay_and_unseen_keys(spark):
    out, kept = new_path(spark, "cout"), new_path(spark, "cstate")
    lags = jobs.CarriedLags("k", ["ts", "id"], "v", out, kept)
    batches = [rows(("a", 1, 1.0), ("b", 1, 5.0)), [], rows(("a", 2, 2.0)), rows(("c", 3, 8.0), ("a", 3, None), ("a", 4, 4.0))]
    for i, b in enumerate(batches):
        lags(spark.createDataFrame(b, SCHEMA), i)
    lags(spark.createDataFrame(batches[3], SCHEMA), 3)
    got = spark.read.parquet(out).orderBy("k", "ts").collect()
    assert [(r["k"], r["v"], r["lag1"], r["lag2"]) for r in got] == [
        ("a", 1.0, None, None), ("a", 2.0, 1.0, None), ("a", None, 2.0, 1.0), ("a", 4.0, None, 2.0),
        ("b", 5.0, None, None), ("c", 8.0, None, None)]


def test_carried_lags_mark_older_rows_and_keep_a_missing_key(spark):
    out, kept = new_path(spark, "lout"), new_path(spark, "lstate")
    lags = jobs.CarriedLags("k", ["ts", "id"], "v", out, kept)
    batches = [rows(("a", 10, 1.0), ("a", 11, 2.0), (None, 1, 3.0)), rows(("a", 5, 7.0), ("a", 12, 4.0), (None, 2, 6.0)), rows((None, 3, 9.0))]
    for i, b in enumerate(batches):
        lags(spark.createDataFrame(b, SCHEMA), i)
    got = {(r["k"], r["v"]): (r["lag1"], r["lag2"], r["late"]) for r in spark.read.parquet(out).collect()}
    assert got[("a", 7.0)] == (None, None, True) and got[("a", 4.0)] == (2.0, 1.0, False)
    assert got[(None, 6.0)] == (3.0, None, False) and got[(None, 9.0)] == (6.0, 3.0, False)
    assert spark.read.parquet(f"{kept}/batch_id=2").count() == 2


def test_late_duplicates_within_the_watermark_are_dropped(spark):
    src, out, cp = (new_path(spark, x) for x in ("src", "out", "cp"))
    a = spark.createDataFrame(rows(("a", 1, 1.0), ("a", 1, 1.0), ("b", 2, 1.0)), SCHEMA)
    a.coalesce(1).write.parquet(f"{src}/p0")
    a.coalesce(1).write.parquet(f"{src}/p1")
    stream = read_files_as_stream(spark, f"{src}/*", a.schema)
    jobs.finish(jobs.start_files(jobs.drop_stream_duplicates(stream, "ts", ["k", "ts"], "1 hour"), out, cp))
    assert spark.read.parquet(out).count() == 2


def test_append_mode_holds_back_only_open_windows(spark):
    src, out, cp = (new_path(spark, x) for x in ("src", "out", "cp"))
    a = spark.createDataFrame(rows(*[("a", m, 1.0) for m in range(0, 600, 10)]), SCHEMA)
    a.coalesce(1).write.parquet(f"{src}/p0")
    stream = read_files_as_stream(spark, f"{src}/*", a.schema)
    kpis = jobs.windowed_kpis(stream, "ts", {"n": F.count("*")}, "1 hour", late="0 seconds")
    jobs.finish(jobs.start_files(kpis, out, cp))
    assert {r["n"] for r in spark.read.parquet(out).collect()} == {6}
    assert spark.read.parquet(out).count() == 9


def test_queries_stop_after_their_time(spark):
    src, out, cp = (new_path(spark, x) for x in ("src", "out", "cp"))
    spark.range(3).write.parquet(f"{src}/p0")
    stream = read_files_as_stream(spark, f"{src}/*", spark.range(1).schema)
    q = jobs.start_batches(stream, lambda b: b, out, cp, "1 second")
    jobs.run_for([q], 0.5)
    assert not q.isActive


def test_bad_messages_become_nulls(spark):
    df = spark.createDataFrame([('{"id": 1, "v": 2.5}',), ("{bad",), ('{"id": "x"}',), ('{"v": NaN}',)], "value string")
    schema = spark.createDataFrame([], "id int, v double").schema
    got = decode(df.withColumn("value", F.col("value").cast("binary")), schema).collect()
    assert (got[0]["id"], got[0]["v"]) == (1, 2.5)
    assert got[1]["id"] is None and got[2]["id"] is None


def test_message_key_is_the_area(spark):
    row = encode(spark.createDataFrame([("x", 1)], "area string, n int"), "area").first()
    assert (row["key"], row["value"]) == ("x", '{"area":"x","n":1}')


def test_kafka_options():
    options = kafka_options("broker:9092", "traffic", 1_000)
    assert options["maxOffsetsPerTrigger"] == "1000" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"


def test_three_streams_meet_in_any_order_of_files(spark):
    """One state row for each area and time; a source that lacks a time, repeated readings, missing values, files in any order."""
    draw = random.Random(5)
    want, sent = {}, {"x": [], "y": [], "z": []}
    for slot in range(30):
        for area in ("a", "b", None):
            for name, table in sent.items():
                if (name, slot % 7) != ("z", 3):
                    values = [None if draw.random() < 0.1 else float(draw.randrange(50)) for _ in range(draw.choice([1, 1, 2]))]
                    table += [(area, T0 + dt.timedelta(minutes=slot), v) for v in values]
                    want.setdefault((area, slot), {})[name] = values
    def mean(v):
        return sum(v) / len(v) if v else None

    expected = {}
    for key, held in want.items():
        known = {n: [v for v in held.get(n, []) if v is not None] for n in sent}
        expected[key] = tuple(x for n in sent for x in (mean(known[n]), len(known[n])))
    for files, complete in ((1, True), (4, False), (None, True)):
        streams = {}
        for name, table in sent.items():
            rows_ = draw.sample(table, len(table))
            src, schema = new_path(spark, f"al{name}"), f"area string, ts timestamp, {name} double"
            for i in range(3):
                spark.createDataFrame(rows_[i::3], schema).coalesce(1).write.parquet(f"{src}/p{i}")
            frame = spark.createDataFrame([], schema)
            state.end_mark(frame, "ts").coalesce(1).write.parquet(f"{src}/p3")
            streams[name] = read_files_as_stream(spark, f"{src}/*", frame.schema, max_files=files)
        out = new_path(spark, "alout")
        aligned = state.align_on_stream(streams, ["area", "ts"], "ts", dt.timedelta(hours=1), complete)
        jobs.finish(jobs.start_files(aligned, out, new_path(spark, "alcp")), lossless=True)
        got = {(r["area"], round((r["ts"].replace(tzinfo=None) - T0.replace(tzinfo=None)).total_seconds() / 60)): tuple(r)[2:]
               for r in spark.read.schema(aligned.schema).parquet(out).collect()}
        assert got == {k: v for k, v in expected.items() if not complete or k[1] % 7 != 3}


def test_many_keys_share_few_state_rows(spark):
    """300 keys over three deliveries, rows out of order, a value without end: as many state rows as there are buckets, and no key meets another."""
    draw, src, out, cp = random.Random(9), *(new_path(spark, x) for x in ("src", "out", "cp"))
    table = [(None if k == 7 else f"k{k}", T0 + dt.timedelta(minutes=10 * part + draw.random() * 9), 10 * k + part, float("inf") if k == 11 else draw.choice([None, 1.0, 2.0]))
             for part in range(3) for k in range(300) for _ in range(draw.choice([1, 2]))]
    table = [(k, ts, i, v) for i, (k, ts, _, v) in enumerate(table)]
    schema, want, before = spark.createDataFrame([], SCHEMA).schema, {}, {}
    for k, ts, i, v in sorted(table, key=lambda r: r[1]):
        held = before.setdefault(k, [])
        smooth = held[-1][1] if held else 0.0
        smooth = smooth if v is None else 0.5 * smooth + 0.5 * v
        want[i] = (k, len(held) + 1, held[-1][0] if held else None, held[-2][0] if len(held) > 1 else None, round(smooth, 9), False)
        held.append((v, smooth))
    cut = [T0 + dt.timedelta(minutes=10 * i) for i in range(4)]
    frames = [spark.createDataFrame([r for r in table if a <= r[1] < b], schema) for a, b in zip(cut, cut[1:])]
    for i, df in enumerate([*frames, state.end_mark(frames[0], "ts")]):
        df.coalesce(1).write.parquet(f"{src}/p{i}")
        stream = read_files_as_stream(spark, f"{src}/*", schema)
        result = state.with_series_state(stream, "k", ["ts", "id"], "v", 0.5, 0.0, wait=dt.timedelta(minutes=10), buckets=4)
        query = jobs.start_files(result, out, cp)
        jobs.finish(query, lossless=True)
        assert query.recentProgress[0]["stateOperators"][0]["numRowsTotal"] < 40
    got = spark.read.schema(result.schema).parquet(out).collect()
    assert {r["id"]: (r["k"], r["seq"], r["lag1"], r["lag2"], round(r["smooth"], 9), r["late"]) for r in got} == want and len(got) == len(table)


def test_joined_streams_keep_a_step_not_the_tables(spark, sf, monkeypatch):
    energy = Tables(spark, sf).energy
    n = energy.count()
    odd = energy.withColumn("timestamp", F.when(F.col("reading_id") % 50 != 0, F.col("timestamp")))  # missing times match nothing
    rows = odd.unionByName(odd.filter("reading_id % 7 = 0"))
    kept = []

    def drain(query, lossless=False):
        given(query, lossless)
        kept.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]])

    given = jobs.drain
    monkeypatch.setattr(jobs, "drain", drain)
    monkeypatch.setattr(q_streaming, "STEP_ROWS", -(-n // 3))
    tables = Tables(spark, sf)
    monkeypatch.setattr(tables, "energy", rows, raising=False)
    found = q_streaming.c09_streams(tables)
    keys = ["area", "timestamp"]
    want = rows.select(*keys, F.col("temperature").alias("vehicle_count")).join(
        rows.filter("load_type <> 'Industrial'").select(*keys, "energy_consumption"), keys).join(
        rows.filter("weather <> 'Rain'").select(*keys, F.col("humidity").alias("AQI")), keys).select(found.columns)
    assert found.count() == want.count() > 0 and found.exceptAll(want).isEmpty()
    assert len(kept[0]) >= 4 and max(kept[0]) < 0.75 * 2 * n  # of the first join; both of its streams whole are 1.9 n
