"""Query lifecycle, idempotent micro-batch writes, windowed KPIs, de-duplication, stream joins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from gridpulse.operators.ordered import OrderedFrame
from gridpulse.scratch import lookup_join
from gridpulse.sources.files import children, remove, touch

Transform = Callable[[DataFrame], DataFrame]


def committed(spark: SparkSession, folder: str, before: int | None = None) -> int:
    """The highest batch id (below ``before``) that has been written whole; -1 if there is none.

    Batches run one after another, so all ids up to it are whole as well, and only the last two marks are kept.
    """
    found = [int(n) for n in children(spark, f"{folder}/_committed") if n.isdigit()]
    return max([n for n in found if before is None or n < before], default=-1)


def commit(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Mark a batch as written whole. The mark is the last thing written; marks but the two newest go."""
    touch(spark, f"{folder}/_committed/{batch_id}")
    for n in sorted((int(n) for n in children(spark, f"{folder}/_committed") if n.isdigit()), reverse=True)[2:]:
        remove(spark, f"{folder}/_committed/{n}")


def write_committed(df: DataFrame, folder: str, batch_id: int) -> None:
    """Write a batch under its id and mark it. A batch that is marked already is whole and stays; one that failed halfway is replaced."""
    spark = df.sparkSession
    if committed(spark, folder) >= batch_id:
        return
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
    commit(spark, folder, batch_id)


def read_committed(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows of all whole batches, without those of a batch that is being written or has failed. ``schema``: without the batch id."""
    last = committed(spark, folder)
    if last < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(StructType([*schema.fields, StructField("batch_id", IntegerType())])).parquet(folder).where(
        F.col("batch_id") <= last).drop("batch_id")


def batch_writer(transform: Transform, folder: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: transform each non-empty batch and write it under its batch id.

    A replayed batch is written once, so a retry leaves no duplicates; see ``read_committed`` for readers at the same time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_committed(transform(batch), folder, batch_id)

    return write


def start_batches(
    stream: DataFrame, transform: Transform, folder: str, checkpoint: str, interval: str | None = "15 seconds"
) -> StreamingQuery:
    """Run ``transform`` per micro-batch; ``interval=None`` handles what is there and ends."""
    writer = stream.writeStream.foreachBatch(batch_writer(transform, folder)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def start_files(stream: DataFrame, folder: str, checkpoint: str, mode: str = "append", interval: str | None = None) -> StreamingQuery:
    """Append to Parquet, handle what is there and end; with an ``interval`` go on until stopped (see ``drain``)."""
    writer = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode(mode)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were left out, over the progress reports that the query holds."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def finish(query: StreamingQuery, timeout: float | None = None, lossless: bool = False) -> None:
    """Wait for an available-now query, which ends by itself; its own error is raised here. A caller may set a limit.

    ``lossless``: rows left out as too late are an error.
    """
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the streaming query did not end within {timeout} s")
    if lossless and (n := dropped_rows(query)):
        raise RuntimeError(f"{n} rows came behind the watermark; the allowed lateness must cover their delay")


def drain(query: StreamingQuery, lossless: bool = False) -> None:
    """Let a query that goes on handle all that its sources hold, in as many micro-batches as they make of it, then stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if lossless and (n := dropped_rows(query)):
        raise RuntimeError(f"{n} rows came behind the watermark; the allowed lateness must cover their delay")


def run_for(queries: Sequence[StreamingQuery], seconds: float) -> None:
    """Let queries run for a while, then stop them all, also when one of them fails."""
    try:
        for q in queries:
            q.awaitTermination(seconds / max(len(queries), 1))
    finally:
        for q in queries:
            q.stop()


def windowed_kpis(
    stream: DataFrame, ts: str, measures: dict[str, Column], window: str, late: str, slide: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Tumbling or sliding aggregates over event time; rows later than ``late`` are left out."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (
        stream.withWatermark(ts, late)
        .groupBy(w.alias("w"), *keys)
        .agg(*[m.alias(n) for n, m in measures.items()])
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *measures)
    )


def start_refreshed_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rewrite a small aggregate table on every trigger (complete mode)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (
        stream.writeStream.foreachBatch(write).outputMode("complete")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drop_stream_duplicates(stream: DataFrame, ts: str, keys: Sequence[str], late: str) -> DataFrame:
    """First row per key; the state of a key ends ``late`` after its time, and so long a row may come out of order (see ``finish``)."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def join_streams(streams: Sequence[DataFrame], ts: str, key: str, late: str) -> DataFrame:
    """Inner join of streams on time and key; the watermarks bound what each side keeps."""
    marked = [df.withWatermark(ts, late) for df in streams]
    out = marked[0]
    for other in marked[1:]:
        out = out.join(other, [ts, key])
    return out


class CarriedLags:
    """Lags over micro-batches with ordinary batch operators, for keys too hot for one state task.

    Each batch takes the last two values per key from the state folder of the batch
    before, computes lags for its own rows, and writes its own state folder. The
    state holds one row per key. Replaying a batch reads and writes the same folders.
    """

    def __init__(self, key: str, order: Sequence[str], column: str, out: str, state: str, **sizes: int):
        self.key, self.order, self.column, self.out, self.state = key, list(order), column, out, state
        self.sizes = sizes

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        order = ", ".join(f"`{c}`: {batch.schema[c].dataType.simpleString()}" for c in self.order)
        state_schema = f"`{self.key}` {batch.schema[self.key].dataType.simpleString()}, _v1 double, _v2 double, _last struct<{order}>"
        if committed(spark, self.state) >= batch_id:
            return  # a replay of a batch whose state is whole
        earlier = committed(spark, self.state, batch_id)  # an empty batch leaves no state
        previous = (spark.read.schema(state_schema).parquet(f"{self.state}/batch_id={earlier}") if earlier >= 0
                    else spark.createDataFrame([], state_schema))
        value = F.col(self.column)
        # A row older than the key's last one is kept and marked, gets no lags and leaves the state as it is.
        placed = lookup_join(batch, previous, self.key, stored=True)
        placed = placed.withColumn("late", F.coalesce(F.struct(*self.order) < F.col("_last"), F.lit(False))).drop("_last")
        frame = OrderedFrame.of(placed, [self.key, "late"], self.order, **self.sizes).windows({
            "_l1": lambda w: F.lag(F.struct(value.alias("v")), 1).over(w),
            "_l2": lambda w: F.lag(F.struct(value.alias("v")), 2).over(w),
        }, 2, 0)
        # A lag struct is NULL only where the batch has no such row: then the carried value counts.
        joined = frame.result()
        first, second = F.col("_l1").isNull(), F.col("_l2").isNull()
        lag1 = F.when(first, F.col("_v1")).otherwise(F.col("_l1.v"))
        lag2 = F.when(first, F.col("_v2")).when(second, F.col("_v1")).otherwise(F.col("_l2.v"))
        on_time = ~F.col("late")
        rows = joined.withColumns({"lag1": F.when(on_time, lag1), "lag2": F.when(on_time, lag2)}).drop("_l1", "_l2", "_v1", "_v2")
        rows.write.mode("overwrite").parquet(f"{self.out}/batch_id={batch_id}")
        done = spark.read.schema(rows.schema).parquet(f"{self.out}/batch_id={batch_id}")
        last = F.max_by(F.struct(value.cast("double").alias("_v1"), F.col("lag1").cast("double").alias("_v2"),
                                 F.struct(*self.order).alias("_last")), F.struct(*self.order))
        fresh = done.where("not late").groupBy(self.key).agg(last.alias("s")).select(self.key, "s.*")
        kept = previous.join(fresh, previous[self.key].eqNullSafe(fresh[self.key]), "left_anti")
        kept.unionByName(fresh).write.mode("overwrite").parquet(f"{self.state}/batch_id={batch_id}")
        commit(spark, self.out, batch_id)
        commit(spark, self.state, batch_id)
        for name in children(spark, self.state):  # the state is whole in each folder; the last two are enough for a replay
            if name.startswith("batch_id=") and int(name[9:]) not in (earlier, batch_id):
                remove(spark, f"{self.state}/{name}")


def start_carried_lags(stream: DataFrame, lags: CarriedLags, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(lags).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
