"""Stored summaries against the whole table: any batching, compaction, replay, large offsets."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from gridpulse.scratch import new_path
from gridpulse.streaming import jobs
from gridpulse.streaming.summaries import Summaries, figures, merge, summarise

draw = random.Random(8)
ROWS = [(draw.choice(["a", "a", "a", "b", None]), draw.choice([1e9 + draw.random(), 1e9 - draw.random(), None, float("nan")]),
         float(draw.randrange(100))) for _ in range(2000)]
NAMES = "k string, x double, y double"


def plain():
    out = {}
    for key in ("a", "b", None):
        for i, m in ((1, "x"), (2, "y")):
            v = [r[i] for r in ROWS if r[0] == key and r[i] is not None and r[i] == r[i]]
            out[key, m] = (len(v), statistics.fmean(v), statistics.stdev(v), min(v), max(v), sorted(v))
    return out


def same(found):
    got = {(r["k"], r["measure"]): r for r in found.collect()}
    want = plain()
    assert got.keys() == want.keys()
    for key, (n, mean, std, low, high, ordered) in want.items():
        r = got[key]
        assert (r["n"], r["low"], r["high"]) == (n, low, high)
        assert r["mean"] == pytest.approx(mean, rel=1e-12) and r["std"] == pytest.approx(std, rel=1e-6)
        for q in (25, 50, 75):
            inside = (sum(v < r[f"q{q}"] for v in ordered) - 1, sum(v <= r[f"q{q}"] for v in ordered) + 1)
            assert inside[0] / n - 0.03 <= q / 100 <= inside[1] / n + 0.03


@pytest.mark.parametrize("parts, every", [(1, 32), (7, 32), (7, 2), (9, 1)])
def test_any_batching_and_compaction(spark, parts, every):
    schema = spark.createDataFrame([], NAMES).schema
    table = Summaries(new_path(spark, "sums"), type(schema)([schema["k"]]), ["x", "y"], every)
    for i in range(parts):
        batch = spark.createDataFrame(ROWS[i::parts], NAMES)
        table(batch, i)
        table(batch, i)  # a replay
    same(figures(table.read(spark), ["k"]))


def test_half_written_batches_are_not_seen(spark):
    schema = spark.createDataFrame([], NAMES).schema
    table = Summaries(new_path(spark, "sums"), type(schema)([schema["k"]]), ["x", "y"])
    assert table.read(spark).count() == 0
    table(spark.createDataFrame(ROWS, NAMES), 0)
    summarise(spark.createDataFrame(ROWS, NAMES), ["k"], ["x"]).write.parquet(f"{table.folder}/parts/batch_id=1")
    same(figures(table.read(spark), ["k"]))


def test_old_parts_go_and_reading_is_bounded(spark):
    schema = spark.createDataFrame([], NAMES).schema
    table = Summaries(new_path(spark, "sums"), type(schema)([schema["k"]]), ["y"], every=2)
    for i in range(8):
        table(spark.createDataFrame([("a", 1.0, float(i))], NAMES), i)
    assert table._parts(spark).count() == 1
    assert len([n for n in jobs.children(spark, f"{table.folder}/parts") if n.startswith("batch")]) <= 3
    assert table.read(spark).first()["n"] == 8


def test_no_rows_and_no_values(spark):
    none = spark.createDataFrame([("a", None, float("nan"))], NAMES)
    assert summarise(none, ["k"], ["x", "y"]).count() == 0
    assert merge(summarise(none.where("false"), ["k"], ["x"]), ["k"]).count() == 0
    assert figures(merge(summarise(spark.createDataFrame([("a", 5.0, 1.0)], NAMES), ["k"], ["x"]), ["k"]), ["k"]).select(
        "n", "mean", "std", F.col("q50")).first() == (1, 5.0, None, 5.0)
