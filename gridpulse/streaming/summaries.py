"""Stored, mergeable summaries of batches: key figures that stay up to date without reading history again.

Of each micro-batch one row for every key and measure is kept: number, mean, sum of squared deviations, smallest and largest value, and a quantile
sketch. Summaries of batches merge into that of all rows: deviations by the pairwise formula around the means (never as a difference of
large squares), sketches by their own union. After every so many batches the parts are merged into one total, so reading takes a bounded number of
rows for each key, however long the stream has run. Parts and totals are committed folders: what is half written is not seen, and a replay
changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from gridpulse.functions.predicates import nan_to_null
from gridpulse.sources.files import children, remove
from gridpulse.streaming.jobs import committed, write_committed


def summarise(df: DataFrame, keys: Sequence[str], measures: Sequence[str], k: int = 400) -> DataFrame:
    """keys, measure and the figures of its values that are neither null nor NaN; ``k`` sets the sketch's accuracy."""
    long = df.select(*keys, *[nan_to_null(c).cast("double").alias(c) for c in measures]).unpivot(list(keys), list(measures), "measure", "value")
    found = long.groupBy(*keys, "measure").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("low"), F.max("value").alias("high"), F.kll_sketch_agg_double("value", k).alias("sketch"))
    return found.where("n > 0")


def merge(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summaries of several batches as one. A key has as many rows as there are parts, which ``Summaries`` bounds."""
    part = F.struct("n", "mean", "m2")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(s: Column, x: Column) -> Column:
        n = s.getField("n") + x.getField("n")
        gap = x.getField("mean") - s.getField("mean")
        share = x.getField("n") / n
        return F.struct(n.alias("n"), (s.getField("mean") + gap * share).alias("mean"),
                        (s.getField("m2") + x.getField("m2") + gap * gap * s.getField("n") * share).alias("m2"))

    grouped = parts.groupBy(*keys, "measure").agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"))
    moments = F.aggregate("parts", zero, add)
    return grouped.withColumn("s", moments).select(*keys, "measure", "s.n", "s.mean", "s.m2", "low", "high", "sketch")


def figures(merged: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Number, mean, sample deviation, band of one deviation, variation, extremes and approximate quantiles of each key and measure."""
    std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    return merged.select(
        *keys, "measure", "n", "mean", std.alias("std"), (F.col("mean") - std).alias("band_low"), (F.col("mean") + std).alias("band_high"),
        F.when(F.col("mean") != 0, std / F.col("mean")).alias("cv"), "low", "high",
        *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(f"q{round(100 * q)}") for q in quantiles])


class Summaries:
    """A table of summaries below ``folder``: call it with micro-batches (``foreachBatch``), ``read`` it at any time."""

    def __init__(self, folder: str, keys: StructType, measures: Sequence[str], every: int = 32, k: int = 400) -> None:
        self.folder, self.keys, self.measures, self.every, self.k = folder, keys.names, list(measures), every, k
        numbers = [StructField("n", LongType()), *[StructField(c, DoubleType()) for c in ("mean", "m2", "low", "high")]]
        self.schema = StructType([*keys.fields, StructField("measure", StringType()), *numbers, StructField("sketch", BinaryType())])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, parts = batch.sparkSession, f"{self.folder}/parts"
        if committed(spark, parts) >= batch_id:
            return
        write_committed(summarise(batch, self.keys, self.measures, self.k), parts, batch_id)
        if (batch_id + 1) % self.every == 0:
            self._total(spark, batch_id)

    def _parts(self, spark: SparkSession) -> DataFrame:
        """The last total and the parts after it."""
        parts, totals = f"{self.folder}/parts", f"{self.folder}/totals"
        done, last = committed(spark, totals), committed(spark, parts)
        out = spark.createDataFrame([], self.schema)
        if done >= 0:
            out = out.unionByName(spark.read.schema(self.schema).parquet(f"{totals}/batch_id={done}"))
        if last > done:
            numbered = spark.read.schema(StructType([*self.schema.fields, StructField("batch_id", LongType())])).parquet(parts)
            out = out.unionByName(numbered.where((F.col("batch_id") > done) & (F.col("batch_id") <= last)).drop("batch_id"))
        return out

    def _total(self, spark: SparkSession, batch_id: int) -> None:
        totals, before = f"{self.folder}/totals", committed(spark, f"{self.folder}/totals")
        write_committed(merge(self._parts(spark), self.keys), totals, batch_id)
        # A reader may still hold the total before this one and the parts after that; what is older is in both totals.
        for name in children(spark, totals):
            if name.startswith("batch_id=") and int(name[9:]) < before:
                remove(spark, f"{totals}/{name}")
        for name in children(spark, f"{self.folder}/parts"):
            if name.startswith("batch_id=") and int(name[9:]) <= before:
                remove(spark, f"{self.folder}/parts/{name}")

    def read(self, spark: SparkSession) -> DataFrame:
        """keys, measure and the figures of all whole batches."""
        return merge(self._parts(spark), self.keys)


def start_summaries(stream: DataFrame, summaries: Summaries, checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(summaries).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

