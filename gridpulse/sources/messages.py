"""Keyed JSON messages: decode, encode, and the Kafka source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def decode(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """JSON payload to columns; bad documents and bad fields become NULL."""
    payload = F.from_json(F.col(value).cast("string"), schema)
    return df.select(payload.alias("d")).select("d.*")


def encode(df: DataFrame, key: str) -> DataFrame:
    """``key`` as the message key (keeps one area in one topic partition), the row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_options(servers: str, topic: str, max_per_trigger: int) -> dict[str, str]:
    """Replayable from the start and limited per trigger."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(max_per_trigger),
    }


def read_kafka(spark: SparkSession, servers: str, topic: str, max_per_trigger: int) -> DataFrame:
    """Streaming source; needs the Spark Kafka package that matches the running version."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, max_per_trigger)).load()


def write_kafka(df: DataFrame, servers: str, topic: str, key: str) -> None:
    encode(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def read_files_as_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """File-backed stream; ``max_files`` per trigger, or all that is there, as one delivery."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)
