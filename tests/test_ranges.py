"""Range join by dyadic blocks against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import ranges


@pytest.mark.parametrize("low, high", [(0, 0), (1, 1), (0, 7), (1, 6), (5, 21), (3, 1000), (1_700_000_001, 1_760_000_017), (0, 2 ** 40)])
def test_blocks_cover_the_range_once(spark, low, high):
    got = spark.range(1).select(ranges.blocks(F.lit(low).cast("long"), F.lit(high).cast("long")).alias("b")).first()["b"]
    spans = sorted((r["block"] << r["level"], (r["block"] + 1) << r["level"]) for r in got)
    assert spans[0][0] == low and spans[-1][1] == high + 1
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert all(n <= 2 for n in {k: sum(r["level"] == k for r in got) for k in {r["level"] for r in got}}.values())


def _plain(rows, spans):
    out = []
    for i, k, at in rows:
        met = [m for key, a, b, m in spans if key == k is not None and at is not None and a is not None and b is not None and a <= at <= b]
        out.append((i, max((m for m in met if m is not None), default=None), len(met) or None))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_all_pairs(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(ranges, "MAX_BROADCAST_ROWS", -1)
    draw = random.Random(2)
    rows = [(i, draw.choice(["a", "a", "b", None]), draw.choice([None, *range(200)])) for i in range(300)]
    spans = [(draw.choice(["a", "b", "c", None]), a, a + draw.randrange(-3, 60), draw.choice([None, 1.0, 2.5, 7.0]))
             for a in [draw.randrange(200) for _ in range(120)]] + [("a", None, 5, 1.0), ("a", 5, None, 1.0), ("a", 50, 50, 9.0), ("a", 50, 50, 9.0)]
    df = spark.createDataFrame(rows, "id int, k string, at long")
    got = ranges.join_ranges(df, spark.createDataFrame(spans, "k string, low long, high long, m double"), ["k"], F.col("at"), "low", "high",
                             {"best": (F.max("m"), F.greatest), "n": (F.count("*"), ranges.total)})
    assert got.columns == ["id", "k", "at", "best", "n"]
    assert [(r["id"], r["best"], r["n"]) for r in got.orderBy("id").collect()] == _plain(rows, spans)


def test_no_ranges_and_no_rows(spark):
    df, spans = spark.createDataFrame([(1, "a", 5)], "id int, k string, at long"), spark.createDataFrame([], "k string, low long, high long, m double")
    how = {"best": (F.max("m"), F.greatest)}
    assert ranges.join_ranges(df, spans, ["k"], F.col("at"), "low", "high", how).collect() == [(1, "a", 5, None)]
    assert ranges.join_ranges(df.where("false"), spans, ["k"], F.col("at"), "low", "high", how).count() == 0


def test_a_range_of_years_is_some_tens_of_rows(spark):
    span = spark.createDataFrame([("a", 1_100_000_007, 1_700_000_003, 1.0)], "k string, low long, high long, m double")
    assert ranges.range_blocks(span, ["k"], "low", "high", {"m": F.max("m")}).count() < 60


@pytest.mark.parametrize("segments, combine", [(1, ranges.total), (4, lambda *parts: ranges.total(*parts)), (1024, ranges.total)])
def test_segments_of_any_size_against_all_pairs(spark, monkeypatch, segments, combine):
    monkeypatch.setattr(ranges, "SEGMENTS", segments)
    draw = random.Random(segments)
    rows = [(i, draw.choice(["a", "b", None]), draw.choice([None, *range(0, 5000, 7)])) for i in range(200)]
    spans = [(draw.choice(["a", "b", None]), a, a + draw.choice([0, 1, 3, 40, 900, 2500, -1]), draw.choice([None, 1.0, 2.5, 7.0]))
             for a in [draw.randrange(4000) for _ in range(150)]] + [("a", 0, 1 << 40, 0.5), ("b", 12, None, 9.0)]
    got = ranges.join_ranges(spark.createDataFrame(rows, "id int, k string, at long"), spark.createDataFrame(spans, "k string, low long, high long, m double"),
                             ["k"], F.col("at"), "low", "high", {"best": (F.max("m"), F.greatest), "n": (F.count("*"), combine)})
    assert [(r["id"], r["best"], r["n"]) for r in got.orderBy("id").collect()] == _plain(rows, spans)


def test_long_ranges_are_not_cut_into_tens_of_rows_each(spark, monkeypatch):
    """What is stored of 20,000 ranges of a week to weeks over two months, by the second, hangs on the segments."""
    stored = []

    def counted(df, label):
        table = ranges_materialize(df, label)
        stored.append(table.count())
        return table

    ranges_materialize = ranges.materialize
    monkeypatch.setattr(ranges, "materialize", counted)
    spans = spark.range(20_000).select(F.lit("a").alias("k"), (F.col("id") * 7919 % 5_000_000).alias("low"), F.lit(1.0).alias("m"),
                                       (F.col("id") * 7919 % 5_000_000 + 600_000 + F.col("id") * 104_729 % 1_000_000).alias("high"))
    df = spark.createDataFrame([("a", 2_500_000)], "k string, at long")
    got = ranges.join_ranges(df, spans, ["k"], F.col("at"), "low", "high", {"n": (F.count("*"), ranges.total)})
    assert got.first()["n"] == spans.where("2500000 between low and high").count()
    assert sum(stored) < 20_000  # 181,365 as blocks of the whole ranges
