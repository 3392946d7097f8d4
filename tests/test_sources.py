"""Files: optional inputs, documents, single-file marts, large values."""

import datetime as dt
from types import SimpleNamespace

import pytest

from gridpulse import scratch
from gridpulse.scratch import new_path
from gridpulse.sources import files


def test_missing_inputs_are_none(spark, tmp_path):
    assert files.read_optional(spark, {"a": str(tmp_path / "no.csv")}) == {"a": None}
    assert files.read_json_document(spark, str(tmp_path / "no.json"), "a int") is None


def test_csv_gets_calendar_columns(spark):
    path = new_path(spark, "t") + ".csv"
    files.write_single_csv(spark.createDataFrame([("2024-01-01T05:00:00", 1)], "timestamp string, n int"), path)
    df = files.read_optional(spark, {"t": path}, {"t": "timestamp timestamp_ntz, n int"})["t"]
    row = df.first()
    assert (row["hour"], row["dayofweek"], row["year"]) == (5, 0, 2024)


def test_csv_keeps_microseconds_and_spaces(spark):
    path = new_path(spark, "csv")
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1, 2, 3, 123456), " x ", None)], "t timestamp_ntz, s string, d double")
    files.write_csv(df, path)
    assert files.read_csv(spark, path, df.schema).collect() == df.collect()


def test_nested_document_and_corrupt_document(spark, tmp_path):
    good, bad = tmp_path / "m.json", tmp_path / "bad.json"
    good.write_text('{\n "traffic": {"mae": 1.5,\n "model": "x"}\n}')
    bad.write_text("{ nothing")
    schema = "traffic struct<mae: double, model: string>"
    assert files.read_json_document(spark, str(good), schema, multi_line=True).first()["traffic"]["mae"] == 1.5
    assert files.read_json_document(spark, str(bad), schema, multi_line=True).count() == 0


def test_single_file_has_no_row_limit(spark):
    path = new_path(spark, "x") + ".csv"
    files.write_single_csv(spark.range(1_000_003).toDF("n"), path)
    assert files.read_csv(spark, path, "n bigint").count() == 1_000_003


def test_single_file_overwrites(spark):
    path = new_path(spark, "one") + ".csv"
    for n in (3, 2):
        files.write_single_csv(spark.range(n).toDF("n"), path)
    assert files.read_csv(spark, path, "n bigint").count() == 2


def test_inventory_adds_up_files(spark):
    path = new_path(spark, "inv")
    spark.range(100).repartition(4).write.parquet(path)
    row = files.inventory({"x": spark.read.parquet(path)}).first()
    assert (row["n_rows"], row["n_columns"]) == (100, 1)
    sizes = [s.getLen() for s in files._fs(spark, path).listStatus(files._path(spark, path)) if s.getPath().getName().startswith("part-")]
    assert row["n_bytes"] == sum(sizes)


def test_shared_folder_is_the_configured_one(spark):
    assert scratch.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = scratch.materialize(spark.range(5))
    assert kept.inputFiles()[0].split("file://")[-1].startswith(scratch.shared_dir(spark))


def test_own_folder_only_in_local_mode():
    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default),
            sparkContext=SimpleNamespace(master=master, applicationId="app-own-folder"))

    made = scratch.shared_dir(session("local[2]"))
    assert made == scratch.shared_dir(session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_dir(session("spark://host:7077"))


def test_release_removes_what_was_written(spark, monkeypatch):
    monkeypatch.setattr(scratch, "shared_dir", lambda s: spark.conf.get("spark.checkpoint.dir") + "/released")
    path = scratch.materialize(spark.range(3)).inputFiles()[0].split("/stage-")[0]
    assert files.exists(spark, path)
    assert scratch.release(spark) and not files.exists(spark, path)


def test_lookup_larger_than_the_limit_is_not_broadcast(spark):
    df, lookup = spark.range(100), spark.range(50).selectExpr("id", "id * 2 as d")
    small = scratch.lookup_join(df, lookup, "id")
    large = scratch.lookup_join(df, lookup, "id", max_rows=10)
    plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (small, large)]
    assert "strategy=broadcast" in plans[0] and "strategy=broadcast" not in plans[1]
    assert small.exceptAll(large).count() == 0


def test_scan_partitions_are_joined_without_a_shuffle(spark):
    large, small = new_path(spark, "t"), new_path(spark, "t")
    spark.range(1000).repartition(8).write.parquet(large)
    spark.range(1000).coalesce(1).write.parquet(small)
    for path, parts, shuffled in ((large, 2, False), (small, 3, True)):
        out = new_path(spark, "t")
        dealt = files.in_parts(spark.read.parquet(path), parts)
        assert ("Exchange" in dealt._jdf.queryExecution().executedPlan().toString()) == shuffled
        files.write_parquet(dealt, out)
        written = spark.read.parquet(out)
        assert files.file_times({"t": written}).first()["n_files"] == parts
        assert sorted(r["id"] for r in written.collect()) == list(range(1000))
