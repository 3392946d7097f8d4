import pytest
from pyspark.sql import functions as F

from gridpulse.sources.rows import RowReader, files_of, read_rows_as_stream


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(1, 1001, numPartitions=7).select("id", F.when(F.col("id") % 5 > 0, F.col("id") / 4).alias("v"),
                                                      F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"))
    df.write.option("parquet.block.size", 1024).parquet(path)
    return path


def run(spark, path, out, limit, batches=None, stretch=40):
    """Runs until all rows are through, or stops after so many micro-batches. Returns the sizes of the micro-batches."""
    sizes = []

    def write(batch, number):
        if batches is not None and len(sizes) >= batches:
            raise RuntimeError("lost")
        sizes.append(batch.count())
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    q = (read_rows_as_stream(spark, path, limit, stretch).writeStream.foreachBatch(write)
         .option("checkpointLocation", f"{out}/marks").start())
    try:
        q.processAllAvailable()
    except Exception:
        if batches is None:
            raise
    finally:
        q.stop()
    return sizes


def test_limit_is_kept_and_rows_are_whole(spark, table, tmp_path):
    sizes = run(spark, table, str(tmp_path / "a"), 300)
    assert sizes == [300, 300, 300, 100]
    got = spark.read.parquet(str(tmp_path / "a/rows")).drop("batch")
    want = spark.read.parquet(table)
    assert got.schema == want.schema and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_restart_neither_loses_nor_repeats(spark, table, tmp_path):
    out = str(tmp_path / "b")
    assert run(spark, table, out, 150, batches=2) == [150, 150]  # the third fails halfway and is asked for again
    assert sum(run(spark, table, out, 400)) == 700
    assert run(spark, table, out, 400) == []  # all is committed: nothing comes again
    ids = [r["id"] for r in spark.read.parquet(f"{out}/rows").select("id").collect()]
    assert sorted(ids) == list(range(1, 1001))


def test_empty_table_and_wrong_limit(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.range(0).write.parquet(path)
    assert files_of(spark.read.parquet(path)) == [] and sum(run(spark, path, str(tmp_path / "c"), 5)) == 0
    with pytest.raises(ValueError):
        read_rows_as_stream(spark, path, 0)


def test_stretches_cover_every_row_once():
    reader = RowReader(None, {"limit": "7", "stretch": "4", "files": '[["a", 5], ["b", 1], ["c", 9]]'})
    rows, start = [], reader.initialOffset()
    while (end := reader.latestOffset()) != start:
        assert end["row"] - start["row"] <= 7
        for s in reader.partitions(start, end):
            assert s.last - s.first <= 4
            rows += [(s.path, i) for i in range(s.first, s.last)]
        start = end
    assert rows == [("a", i) for i in range(5)] + [("b", 0)] + [("c", i) for i in range(9)]
