"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridpulse.functions.calendar import with_calendar
from gridpulse.operators.reshape import select_once


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist, on whatever file system it names?"""
    return bool(_fs(spark, path).exists(_path(spark, path)))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none where it does not exist."""
    fs, at = _fs(spark, path), _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, which exists at once or not at all."""
    _fs(spark, path).create(_path(spark, path), True).close()


def remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with header and empty text as NULL. A given schema saves the inference pass."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_csv`` with inferred types, for files of unknown layout (one extra pass)."""
    return spark.read.option("inferSchema", True).option("header", True).option("nullValue", "").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_optional(
    spark: SparkSession, paths: dict[str, str], schemas: dict[str, StructType | str] | None = None
) -> dict[str, DataFrame | None]:
    """Tables that may not have been written yet; a missing one is None.

    Parquet folders carry their own schema; CSV uses the given one where there is
    one. Calendar columns are added where a timestamp is present.
    """
    found: dict[str, DataFrame | None] = {}
    for name, path in paths.items():
        if not exists(spark, path):
            found[name] = None
            continue
        if path.endswith(".csv"):
            given = (schemas or {}).get(name)
            df = read_csv(spark, path, given) if given is not None else read_csv_inferred(spark, path)
        else:
            df = spark.read.parquet(path)
        found[name] = with_calendar(df) if "timestamp" in df.columns else df
    return found


def read_json_document(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> DataFrame | None:
    """JSON rows (or one document over many lines); None if absent, no rows where it does not parse."""
    if not exists(spark, path):
        return None
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "DROPMALFORMED")
    return reader.json(path)


def in_parts(df: DataFrame, parts: int) -> DataFrame:
    """``df`` in ``parts`` partitions with rows. Where the scan has that many they are joined as they are, so that a task reads stored
    bytes and no shuffled rows; a smaller table (or one with empty scan partitions) is dealt out."""
    filled = df.groupBy(F.spark_partition_id()).count().count()
    return df.coalesce(parts) if parts <= filled == df.rdd.getNumPartitions() else df.repartition(parts)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet folder, dropping columns whose name repeats."""
    if len({c.lower() for c in df.columns}) < len(df.columns):
        df = select_once(df)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


# Spark's CSV writer would cut times to milliseconds and trim text.
CSV_WRITE = {
    "header": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a folder of CSV parts, written in parallel."""
    df.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One named CSV file of any size. One task writes it, so it is meant for aggregates; ``write_csv`` writes in parallel."""
    spark = df.sparkSession
    folder = f"{path}.parts"
    write_csv(df.coalesce(1), folder)
    fs = _fs(spark, path)
    part = next(s.getPath() for s in fs.listStatus(_path(spark, folder)) if s.getPath().getName().startswith("part-"))
    target = _path(spark, path)
    if fs.exists(target):
        fs.delete(target, True)
    fs.rename(part, target)
    fs.delete(_path(spark, folder), True)


def write_predictions(df: DataFrame, folder: str, name: str) -> None:
    """Scored rows as CSV and as Parquet, with a time without zone."""
    if "timestamp" in df.columns:
        df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    write_csv(df, f"{folder}/{name}_csv")
    write_parquet(df, f"{folder}/{name}_parquet")


def metrics_rows(df: DataFrame) -> DataFrame:
    """Model metrics as stored: four digits, feature names as one text."""
    return df.withColumns({
        **{c: F.round(c, 4) for c in ("mae", "rmse", "r2")},
        "features": F.array_join("features", ", "),
    })


def write_metrics(df: DataFrame, path: str) -> None:
    """One JSON row per dataset (a handful of rows)."""
    metrics_rows(df).coalesce(1).write.mode("overwrite").json(path)


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and stored bytes per file-backed table.

    Files are reduced to one row each before their sizes are added.
    """
    rows = []
    for name, df in tables.items():
        files = df.groupBy(F.col("_metadata.file_path").alias("p")).agg(
            F.max("_metadata.file_size").alias("s"), F.count("*").alias("n"))
        rows.append(files.agg(
            F.lit(name).alias("dataset"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"), F.coalesce(F.sum("s"), F.lit(0)).alias("n_bytes"),
        ))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def freshness(tables: dict[str, DataFrame]) -> DataFrame:
    """Latest modification time over all files of all tables."""
    return file_times(tables).agg(F.max("latest").alias("latest"))


def file_times(tables: dict[str, DataFrame]) -> DataFrame:
    """First and latest modification time of each table's files, and their number; a table without rows has none."""
    rows = []
    for name, df in tables.items():
        files = df.groupBy(F.col("_metadata.file_path").alias("p")).agg(F.max("_metadata.file_modification_time").alias("t"))
        rows.append(files.agg(F.lit(name).alias("dataset"), F.min("t").alias("first"), F.max("t").alias("latest"), F.count("*").alias("n_files")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
