"""Keyed state per sensor: event-time order, lags, smoothing and sequence numbers on a stream.

Rows wait in list state until the stream is ``wait`` past them, then leave in order by key, so lags, numbers and smoothing do not
hang on how the source cuts the rows into micro-batches: a row may come up to ``wait`` after rows with later times. Keys share state rows, dealt by
hash into a fixed number of buckets, because each state row costs calls to the store whatever it holds; all keys of a bucket are placed together. A
timer for each bucket wakes it when its earliest waiting row is due, also when no further rows come.

Spark drops rows behind the watermark. The watermark therefore stays ``keep`` behind (years), and the timers are set by the difference of the two
earlier. A row that comes later than ``wait``, behind one of its key that has left already, is kept, marked ``late``, gets no lags and leaves the
state as it is. Times must lie after 1970 plus ``keep``. ``end_mark`` ends a stream: everything that waits leaves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from gridpulse.operators.ordered import OrderedFrame

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A row of this time (or later) is no reading but the end of its stream.
END = dt.datetime(2200, 1, 1, tzinfo=dt.timezone.utc)
_END_US = int(END.timestamp()) * 1_000_000
KEEP = dt.timedelta(days=3650)

STATE = "series binary, due bigint"  # a packed table of SERIES by key; due: the timer that is set, if any
SERIES = {"last_us": "int64", "seq": "int64", "lag1": "float64", "lag2": "float64", "smooth": "float64"}
#: Buckets of keys. A bucket's waiting rows are in one task's memory at a time; a query keeps the number that its checkpoint began with.
BUCKETS = 1024


def use_rocksdb(spark: SparkSession) -> None:
    """Timers and lists in state need this store; a query that is under way keeps the one that its checkpoint names."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def end_mark(stream: DataFrame, ts: str) -> DataFrame:
    """One row with no value but a time beyond all readings; delivered after the last one it ends the stream."""
    columns = [(F.lit(END) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    return stream.sparkSession.range(1).select(*columns)


def affine_scan(values: np.ndarray, weight: float, start: float | np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
    """``(1 - weight) * before + weight * value`` from ``start``, a missing value repeating the result before it.

    A row maps the result before it to ``keep * before + own``; maps of neighbours are composed, over stretches of doubling length. ``places``:
    each row's place in its series from 0 on, where several series, with a start for each row, follow one another.
    """
    known = ~np.isnan(values)
    keep, own, step = np.where(known, 1.0 - weight, 1.0), np.where(known, weight * np.where(known, values, 0.0), 0.0), 1
    places = np.arange(len(values)) if places is None else places
    while step <= places.max(initial=0):
        later = np.flatnonzero(places >= step)
        own[later] = own[later] + keep[later] * own[later - step]
        keep[later] = keep[later] * keep[later - step]
        step *= 2
    return own + keep * start


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(payload: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(payload).read_pandas()


_KEY, _BUCKET = "_state_key", "_state_bucket"


def _as_text(key: str) -> Column:
    """A key as text that is never null: a numeric key with nulls would reach Python as NaN, which is equal to no key."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(_KEY, _as_text(key)).withColumn(_BUCKET, F.pmod(F.xxhash64(_KEY), F.lit(buckets)).cast("int"))


def micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype("int64")


def joined(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = [f for f in frames if len(f)]
    return parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()


class OrderBuffer(StatefulProcessor):
    """Holds the rows of a bucket of keys back until they are due; ``placed`` gives the columns of those that leave."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], column: str, weight: float, seed: float, wait: dt.timedelta, keep: dt.timedelta,
                 first: Sequence[str] = ()) -> None:
        # Columns that are computed come to Python without their names.
        self.columns, self.first = [*columns, _KEY, _BUCKET], [*first, _KEY, _BUCKET]
        self.order, self.column, self.weight, self.seed = list(order), column, weight, seed
        self.ahead = int((keep - wait).total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getListState("runs", "payload binary")
        self.series = handle.getValueState("series", STATE)  # one value, as each access is a call to the store

    def _held(self) -> tuple[pd.DataFrame, int | None]:
        """Where the series of the bucket's keys stand, by key, and the timer that is set."""
        payload, due = self.series.get() or (None, None)
        if payload is None:
            return pd.DataFrame({c: np.empty(0, kind) for c, kind in SERIES.items()}, index=pd.Index([], dtype=object)), due
        return _unpacked(payload).set_index(_KEY).astype(SERIES), due

    def _hold(self, held: pd.DataFrame, due: int | None) -> None:
        self.series.update((_packed(held.rename_axis(_KEY).reset_index()) if len(held) else None, due))

    def _wake(self, first_us: int, due: int | None) -> int:
        """The timer to have: an earlier one takes the place of that set."""
        ms = first_us // 1000 - self.ahead
        if due is not None and due <= ms:
            return due
        if due is not None:
            self.handle.deleteTimer(due)
        self.handle.registerTimer(ms)
        return ms

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        came = joined(f.set_axis(self.columns, axis=1) for f in rows).drop(columns=_BUCKET)
        times = micros(came[self.order[0]])
        came, times = came[times < _END_US], times[times < _END_US]
        if not len(came):
            return
        held, due = self._held()
        at = held.index.get_indexer(came[_KEY].to_numpy(dtype=object))
        late = times < np.append(held["last_us"].to_numpy(), np.iinfo(np.int64).min)[at]  # -1 where the key has no series yet
        if late.any():
            yield self._columns(came[late])
        if not late.all():
            self.runs.appendValue((_packed(came[~late]),))
            wake = self._wake(int(times[~late].min()), due)
            if wake != due:
                self._hold(held, wake)

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) + self.ahead
        rows = joined(_unpacked(payload) for (payload,) in self.runs.get())
        held, _ = self._held()
        self.runs.clear()
        times = micros(rows[self.order[0]]) if len(rows) else np.empty(0, np.int64)
        go, due = times // 1000 <= until, None
        if not go.all():
            self.runs.appendValue((_packed(rows[~go]),))
            due = self._wake(int(times[~go].min()), None)
        if go.any():
            ready = rows[go]
            keys = pd.factorize(ready[_KEY].to_numpy(dtype=object))[0]
            out, held = self.placed(ready.iloc[np.lexsort([*[ready[c].to_numpy() for c in reversed(self.order)], keys])], held)
            yield out
        self._hold(held, due)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        """Rows of ``last_values``: the series go on where the history ends."""
        held, due = self._held()
        first = initialState.set_axis(self.first, axis=1).drop_duplicates(_KEY).set_index(_KEY)[list(SERIES)]
        first = first.assign(smooth=first["smooth"].astype("float64").fillna(self.seed)).astype(SERIES)
        self._hold(pd.concat([held.drop(first.index, errors="ignore"), first]), due)

    def placed(self, rows: pd.DataFrame, held: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Columns of rows ordered by key, continuing the keys' series, and the series after them."""
        keys = rows[_KEY].to_numpy(dtype=object)
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(begins, len(rows)))
        ends, places = begins + sizes - 1, np.arange(len(rows)) - np.repeat(begins, sizes)
        before = held.reindex(keys[begins])
        seq, lag1, lag2, smooth = (np.repeat(before[c].fillna(none).to_numpy(), sizes) for c, none in (
            ("seq", 0), ("lag1", np.nan), ("lag2", np.nan), ("smooth", self.seed)))
        values = rows[self.column].to_numpy(dtype="float64", na_value=np.nan)
        one, two = (np.append(np.full(k, np.nan), values)[:len(rows)] for k in (1, 2))
        lag1, lag2 = np.where(places > 0, one, lag1), np.where(places > 1, two, np.where(places > 0, lag1, lag2))
        seq, smooth = seq.astype("int64") + places + 1, affine_scan(values, self.weight, smooth, places)
        after = pd.DataFrame({"last_us": micros(rows[self.order[0]])[ends], "seq": seq[ends], "lag1": values[ends], "lag2": lag1[ends],
                              "smooth": smooth[ends]}, index=keys[begins])
        return self._columns(rows, seq, lag1, lag2, smooth), pd.concat([held.drop(after.index, errors="ignore"), after])

    def _columns(self, rows: pd.DataFrame, seq: np.ndarray | None = None, *numbers: np.ndarray) -> pd.DataFrame:
        none = np.full(len(rows), np.nan)
        lag1, lag2, smooth = numbers or (none, none, none)
        number = pd.array([pd.NA] * len(rows) if seq is None else seq, dtype="Int64")
        return pd.DataFrame({**{c: rows[c].array for c in rows.columns if c != _KEY}, "seq": number, "lag1": lag1, "lag2": lag2, "smooth": smooth,
                             "late": np.full(len(rows), seq is None)})

    def close(self) -> None:
        pass


def last_values(history: DataFrame, key: str, order: Sequence[str], column: str, smooth: str | None = None, **sizes: int) -> DataFrame:
    """Where each key's series stands after ``history``: time and number of its last row, its last two values, its ``smooth`` column if there is one."""
    frame = OrderedFrame.of(history, [key], order, **sizes).windows({"_before": lambda w: F.lag(column, 1).over(w)}, 1, 0)
    last = F.max_by(F.struct(
        F.unix_micros(order[0]).alias("last_us"), F.col(column).cast("double").alias("lag1"), F.col("_before").cast("double").alias("lag2"),
        (F.col(smooth) if smooth else F.lit(None)).cast("double").alias("smooth")), F.struct(*order))
    found = frame.result().groupBy(key).agg(last.alias("last"), F.count("*").alias("seq"))
    return found.select(key, "last.last_us", "seq", "last.lag1", "last.lag2", "last.smooth")


def with_series_state(
    stream: DataFrame, key: str, order: Sequence[str], column: str, weight: float = 0.32, seed: float = 0.0,
    wait: dt.timedelta = dt.timedelta(minutes=1), keep: dt.timedelta = KEEP, first: DataFrame | None = None, buckets: int | None = None,
) -> DataFrame:
    """Add seq, lag1, lag2, smooth and late to each row; ``order[0]`` is the event time. ``first``: ``last_values`` of what came before the stream.

    ``buckets``: state rows that the keys share (``BUCKETS`` if not given); a checkpoint goes on with the number that it began with only.
    """
    schema = StructType([
        *stream.schema.fields,
        StructField("seq", LongType()), StructField("lag1", DoubleType()), StructField("lag2", DoubleType()),
        StructField("smooth", DoubleType()), StructField("late", BooleanType()),
    ])
    use_rocksdb(stream.sparkSession)
    marked = stream.withWatermark(order[0], f"{int(keep.total_seconds())} seconds")
    buckets = buckets or BUCKETS
    return _bucketed(marked, key, buckets).groupBy(_BUCKET).transformWithStateInPandas(
        OrderBuffer(stream.columns, order, column, weight, seed, wait, keep, () if first is None else first.columns), schema, "Append", "EventTime",
        initialState=None if first is None else _bucketed(first, key, buckets).groupBy(_BUCKET))


class Aligner(StatefulProcessor):
    """Sum and number of the values that each source has sent for one key; one row leaves when the stream is past the key's time."""

    def __init__(self, ts: str, keys: Sequence[str], sources: Sequence[str], complete: bool, hold: dt.timedelta, keep: dt.timedelta) -> None:
        self.ts, self.keys, self.sources, self.complete = ts, list(keys), list(sources), complete
        self.ahead = int((keep - hold).total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        columns = ", ".join(f"sum{i} double, n{i} bigint, came{i} bigint" for i in range(len(self.sources)))
        self.held = handle.getValueState("held", columns)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        came = joined(rows)
        times = micros(came[self.ts])
        came, times = came[times < _END_US], times[times < _END_US]
        if not len(came):
            return iter(())
        before = self.held.get()
        if before is None:
            self.handle.registerTimer(int(times.max()) // 1000 - self.ahead)
        held = list(before or (0.0, 0, 0) * len(self.sources))
        for source, values in came.groupby("source")["value"]:
            i = 3 * self.sources.index(source)
            held[i] += float(values.sum())
            held[i + 1] += int(values.count())
            held[i + 2] += len(values)
        self.held.update(tuple(held))
        return iter(())  # rows leave by the timer

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.held.get()
        self.held.clear()
        if held is None or (self.complete and not all(held[2::3])):
            return
        row = dict(zip(self.keys, key if isinstance(key, tuple) else (key,)))
        for i, source in enumerate(self.sources):
            n = held[3 * i + 1]
            row[source], row[f"n_{source}"] = (held[3 * i] / n if n else np.nan), n
        yield pd.DataFrame([row])

    def close(self) -> None:
        pass


def align_on_stream(streams: dict[str, DataFrame], keys: Sequence[str], ts: str, hold: dt.timedelta, complete: bool = True,
                    keep: dt.timedelta = KEEP) -> DataFrame:
    """Means of several streams side by side, one row for each key once the stream is ``hold`` past the key's time ``ts``.

    ``streams``: name of the value column -> rows with it, the keys and ``ts``, which is the same for all rows of a key. The streams are one with
    a column that says where a row is from, so there is one state row for a key, whatever comes first; rows leave only when it is due, so neither
    the order of files nor of sources matters within ``hold``. ``complete``: keys that a source has not sent are left out, else its mean
    is null and its number 0. Missing values do not count. ``end_mark`` lets everything leave.
    """
    kept = [*keys, *[c for c in [ts] if c not in keys]]
    parts = [df.select(*kept, F.lit(name).alias("source"), F.col(name).cast("double").alias("value")) for name, df in streams.items()]
    one = reduce(DataFrame.unionByName, parts)
    use_rocksdb(one.sparkSession)
    names = [f"{_KEY}_{i}" for i in range(len(keys))]
    marked = one.withWatermark(ts, f"{int(keep.total_seconds())} seconds").withColumns(
        {n: _as_text(k) for n, k in zip(names, keys)})
    fields = [StructField(n, StringType()) for n in names]
    for name in streams:
        fields += [StructField(name, DoubleType()), StructField(f"n_{name}", LongType())]
    found = marked.groupBy(*names).transformWithStateInPandas(
        Aligner(ts, names, list(streams), complete, hold, keep), StructType(fields), "Append", "EventTime")
    typed = [F.when(F.col(n) != "", F.substring(n, 2, 1 << 30)).cast(one.schema[k].dataType).alias(k) for n, k in zip(names, keys)]
    return found.select(*typed, *[c for name in streams for c in (name, f"n_{name}")])
