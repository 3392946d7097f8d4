"""Sharding: the permutation by hand, against the columns, over odd rows, files of shards."""

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import queries, sharding
from gridpulse.scratch import new_path


@pytest.mark.parametrize("total", [1, 2, 3, 7, 100, 101, 120, 121, 122, 5000])
def test_permutation_and_its_inverse(total):
    found = [sharding.permute(i, total, 3) for i in range(total)]
    assert sorted(found) == list(range(total))
    assert [sharding.restore(x, total, 3) for x in found] == list(range(total))


@pytest.mark.parametrize("total", [1, 2, 5, 50, 101, 1000, 4097])
def test_columns_agree_with_numbers_and_every_walk_ends(spark, total):
    got = sharding.permuted(spark.range(total).select("id", F.col("id").alias("number")), "number", total, 5).collect()
    assert all(r["number"] == sharding.permute(r["id"], total, 5) for r in got) and len(got) == total


def test_order_looks_random():
    """Neighbours do not stay neighbours, no residue of the number or of its place is favoured, seeds differ."""
    total = 20_000
    found = [sharding.permute(i, total, 1) for i in range(total)]
    assert sum(abs(a - b) < 200 for a, b in zip(found, found[1:])) < 0.03 * total
    for part in (7, 40, 141, 142):
        counts = [0] * part
        for i, x in enumerate(found):
            counts[(i + x) % part] += 1
        mean = total / part
        assert sum((c - mean) ** 2 / mean for c in counts) < part + 6 * (2 * part) ** 0.5
    assert sum(a == sharding.permute(i, total, 2) for i, a in enumerate(found)) < 10


def test_large_totals():
    for total in (10 ** 9 + 7, 5 * 10 ** 10, 2 ** 40):
        for i in (0, 1, total // 3, total - 1):
            shard, slot = sharding.place(i, total, 40, 9)
            assert sharding.row_at(shard, slot, total, 40, 9) == i and 0 <= slot * 40 + shard < total


def _laws(rows, shards):
    held = {}
    for r in rows:
        held.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(held.get(s, [])) for s in range(shards)]
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)


def test_odd_rows(odd):
    got = sharding.digests(sharding.shard(odd, 5)).collect()
    _laws(got, 5)
    assert len(got) == odd.count()
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in odd.collect())
    assert sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_same_places_for_any_partitioning(odd):
    more = odd.where("doc_id is not null").dropDuplicates()
    want = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(more.coalesce(1), 3).collect()}
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(more.repartition(7, "source"), 3).collect()} == want


def test_columns_named_like_results_are_replaced(spark):
    rows = spark.range(7).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("old").alias("Shard"), F.lit(-1).alias("slot"),
                                 F.lit(1).alias("left"), F.lit(1).alias("number"), F.lit(1).alias("held"), F.create_map(F.lit(1), F.lit(2)).alias("m"))
    got = sharding.shard(rows, 2)
    assert got.columns == ["doc_id", "text", "left", "number", "held", "m", "shard", "slot"]
    _laws(got.collect(), 2)


def test_more_shards_than_rows_and_no_rows(spark, none):
    got = sharding.shard(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")), 40).collect()
    assert {r["slot"] for r in got} == {0} and len({r["shard"] for r in got}) == 3
    assert sharding.digests(sharding.shard(none, 40)).count() == 0


def test_one_key_on_a_third_of_the_rows(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") % 2 == 0, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    _laws(sharding.shard(rows, 7).collect(), 7)


def test_written_shards_are_in_slot_order(spark, odd):
    path = new_path(spark, "shards")
    sharding.write(odd, path, 3, rows_per_file=3)
    back = spark.read.parquet(path)
    _laws(back.collect(), 3)
    files = [r["f"] for r in back.select(F.input_file_name().alias("f")).distinct().collect()]
    for f in files:
        slots = [r["slot"] for r in spark.read.parquet(f).coalesce(1).collect()]
        assert slots == sorted(slots) and len(slots) <= 3
    assert len(files) >= 4


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    names = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = con.execute(f"select {', '.join(names)} from ({queries.SQL['op13_sharding']}) order by doc_id").fetchall()
    got = [tuple(r) for r in queries.QUERIES["op13_sharding"](spark, sf).select(*names).orderBy("doc_id").collect()]
    assert got == want and len(got) == 200
