"""Row-order work (lags, fills, rolling windows, running sums) that splits hot keys.

A window partitioned by a key puts all rows of that key into one task, and an
un-partitioned one puts the whole table there. ``OrderedFrame`` first measures
the largest group. Groups that fit a task use plain windows. Otherwise the rows
are range-partitioned by (keys, order), so one hot key spreads over many
partitions, and get an exact 0-based position. Positions are cut into segments
of ``segment_rows``; rows near a boundary are copied into the neighbouring
segment (halo) so that bounded frames see all they need, and unbounded ones
(fill, running sum) take over a per-segment carry. Results are the same as with
one window over the whole group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridpulse.scratch import MAX_BROADCAST_ROWS, materialize

MAX_GROUP_ROWS = 2_000_000
SEGMENT_ROWS = 500_000
_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest key group (of the table when there are no keys)."""
    if not keys:
        return df.count()
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def with_position(df: DataFrame, order: Sequence[str], out: str = "_pos") -> DataFrame:
    """Exact 0-based global rank in ``order``; the columns must order rows totally.

    One range shuffle, written once so that both passes see the same partitions;
    the offsets table has one row per shuffle partition.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    stored = (
        materialize(tagged, "ordered")
        .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
        .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    )
    sizes = stored.groupBy("_pid").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        stored.join(F.broadcast(offsets), "_pid")
        .withColumn(out, F.col("_start") + F.col("_local"))
        .drop("_mid", "_pid", "_local", "_start")
    )


class OrderedFrame:
    """Rows with a known order inside each key, windowed plainly or by segments."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], segment_rows: int | None):
        self.df, self.keys, self.order, self.segment_rows = df, list(keys), list(order), segment_rows

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        max_group_rows: int = MAX_GROUP_ROWS,
        segment_rows: int = SEGMENT_ROWS,
    ) -> OrderedFrame:
        """``max_group_rows=0`` skips the measuring and always works by segments."""
        keys = list(keys)
        if max_group_rows > 0 and largest_group(df, keys) <= max_group_rows:
            return cls(df, keys, order, None)
        placed = with_position(df, [*keys, *[c for c in order if c not in keys]])
        seg = F.expr(f"_pos div {segment_rows}")
        return cls(placed.withColumn("_seg", seg), keys, order, segment_rows)

    @property
    def split(self) -> bool:
        return self.segment_rows is not None

    def _spec(self) -> WindowSpec:
        if not self.split:
            return Window.partitionBy(*self.keys).orderBy(*self.order)
        return Window.partitionBy("_seg", *self.keys).orderBy("_pos")

    def _with(self, df: DataFrame) -> OrderedFrame:
        return OrderedFrame(df, self.keys, self.order, self.segment_rows)

    def _halo(self, before: int, after: int) -> DataFrame:
        """Each row in its own segment, boundary rows also in the neighbouring ones."""
        b = self.segment_rows
        targets = F.array_distinct(F.array(
            F.col("_seg"),
            F.expr(f"cast(floor((_pos - {after}) / cast({b} as double)) as bigint)"),
            F.expr(f"(_pos + {before}) div {b}"),
        ))
        return (
            self.df.withColumn("_own", F.col("_seg"))
            .withColumn("_seg", F.explode(targets))
            .filter(F.col("_seg") >= 0)
        )

    def windows(
        self, columns: dict[str, Callable[[WindowSpec], Column]], before: int, after: int
    ) -> OrderedFrame:
        """Add bounded-frame window columns; ``before``/``after`` bound every frame used."""
        spec = self._spec()
        exprs = {name: make(spec) for name, make in columns.items()}
        if not self.split:
            return self._with(self.df.withColumns(exprs))
        if max(before, after) > self.segment_rows:  # a frame reaches into the neighbouring segments only
            longer = max(before, after)
            frame = OrderedFrame(self.df.withColumn("_seg", F.expr(f"_pos div {longer}")), self.keys, self.order, longer)
            return frame.windows(columns, before, after)
        done = self._halo(before, after).withColumns(exprs)
        return self._with(done.filter(F.col("_seg") == F.col("_own")).drop("_own"))

    def _carry(self, columns: dict[str, Column], combine: Callable[[Column], Column]) -> DataFrame:
        """Per segment and key, what earlier segments of the same key hand over.

        Only the key that touches a segment's last position can continue, so the
        table has at most one row per segment.
        """
        b = self.segment_rows
        tails = (
            self.df.groupBy("_seg", *self.keys)
            .agg(F.max("_pos").alias("_last"), *[v.alias(k) for k, v in columns.items()])
            .filter((F.col("_last") + 1) % b == 0)
        )
        tails = materialize(tails.drop("_last"), "carry")
        upto = Window.partitionBy(*self.keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, 0)
        carried = tails.select(
            (F.col("_seg") + 1).alias("_seg"),
            *self.keys,
            *[combine(F.col(c)).over(upto).alias(c) for c in columns],
        )
        return F.broadcast(carried) if tails.count() <= MAX_BROADCAST_ROWS else carried

    def _join_carry(self, df: DataFrame, carried: DataFrame) -> DataFrame:
        c = carried.select(*[F.col(x).alias(f"_c_{x}") for x in carried.columns])
        on = F.col("_seg") == F.col("_c__seg")
        for k in self.keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
        return df.join(c, on, "left").drop("_c__seg", *[f"_c_{k}" for k in self.keys])

    def forward_fill(self, columns: Sequence[str]) -> OrderedFrame:
        """Last non-null value so far, per key."""
        frame = self._spec().rowsBetween(Window.unboundedPreceding, 0)
        filled = {c: F.last(c, ignorenulls=True).over(frame) for c in columns}
        if not self.split:
            return self._with(self.df.withColumns(filled))
        tails = {f"_t_{c}": F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))) for c in columns}
        carried = self._carry(tails, lambda x: F.last(x, ignorenulls=True))
        out = self._join_carry(self.df.withColumns(filled), carried)
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"_c__t_{c}")) for c in columns})
        return self._with(out.drop(*[f"_c__t_{c}" for c in columns]))

    def filled_lags(self, column: str, names: dict[str, int]) -> OrderedFrame:
        """Lags of ``column`` with gaps filled forward: the last value up to ``k`` rows back, which is one window over the rows for all lags."""
        def upto(k: int) -> Callable[[WindowSpec], Column]:
            return lambda w: F.last(column, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -k))

        deepest = max(names.values())
        done = self.windows({out: upto(k) for out, k in names.items()}, before=deepest, after=0)
        if not self.split:
            return done
        # A segment's own rows and the ``deepest`` before them are in its windows; what lies further back is carried, read off the narrow rows.
        b = done.segment_rows
        back = self.df.withColumn("_pos", F.col("_pos") + deepest).withColumn("_seg", F.expr(f"_pos div {b}"))
        tails = {"_t": F.max_by(column, F.when(F.col(column).isNotNull(), F.col("_pos")))}
        carried = OrderedFrame(back, self.keys, self.order, b)._carry(tails, lambda x: F.last(x, ignorenulls=True))
        out = self._join_carry(done.df, carried)
        return done._with(out.withColumns({c: F.coalesce(F.col(c), F.col("_c__t")) for c in names}).drop("_c__t"))

    def running_sum(self, column: str, out: str) -> OrderedFrame:
        """Inclusive running sum per key."""
        frame = self._spec().rowsBetween(Window.unboundedPreceding, 0)
        local = self.df.withColumn(out, F.sum(column).over(frame))
        if not self.split:
            return self._with(local)
        carried = self._carry({"_t": F.sum(column)}, F.sum)
        joined = self._join_carry(local, carried)
        # A segment may begin with missing values: then its own sum is NULL and the carry alone counts.
        total = F.coalesce(F.col(out) + F.col("_c__t"), F.col(out), F.col("_c__t"))
        return self._with(joined.withColumn(out, total).drop("_c__t"))

    def smooth(self, column: str, out: str, weight: float, seed: float) -> OrderedFrame:
        """Exponential smoothing ``(1-weight)*previous + weight*value`` from ``seed``, per key;
        a missing value repeats the previous result.

        A recursion is no window function, so each bounded group runs in one Arrow
        call. A stretch of rows maps the state before it to ``keep * state + own``, so by
        segments each one is smoothed from zero, the maps of one row per segment are
        composed in order, and every row adds its share of the state it starts from.
        """
        groups = ["_seg", *self.keys] if self.split else self.keys
        by = ["_pos"] if self.split else self.order
        start_at = 0.0 if self.split else seed
        schema = self.df.withColumns({out: F.lit(0.0).cast("double"), "_keep": F.lit(0.0).cast("double")}).schema

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(by)
            values = rows[column].astype("float64")
            series = pd.concat([pd.Series([start_at], dtype="float64"), values], ignore_index=True)
            smoothed = series.ewm(alpha=weight, adjust=False, ignore_na=True).mean()
            return rows.assign(**{out: smoothed.iloc[1:].to_numpy(), "_keep": (1.0 - weight) ** values.notna().cumsum().to_numpy()})

        done = self.df.groupBy(*groups).applyInPandas(run, schema)
        if not self.split:
            return self._with(done.drop("_keep"))
        # The rows' partitions are read twice: once for the last row of each segment.
        done = materialize(done, "smoothed")
        ends = done.groupBy("_seg", *self.keys).agg(F.max_by(F.struct(F.col(out).alias("own"), F.col("_keep").alias("keep")), "_pos").alias("m"))
        keyed = ends.select("_seg", *self.keys, "m.*")

        def compose(rows: pd.DataFrame) -> pd.DataFrame:  # one row for each segment of a key
            rows, state, states = rows.sort_values("_seg"), seed, []
            for own, keep in zip(rows["own"].tolist(), rows["keep"].tolist()):
                states.append(state)
                state = keep * state + own
            return rows.assign(state=states).drop(columns=["own", "keep"])

        carry_schema = keyed.drop("own", "keep").withColumn("state", F.lit(0.0).cast("double")).schema
        states = keyed.groupBy(*self.keys).applyInPandas(compose, carry_schema)
        joined = self._join_carry(done, states)
        total = F.col(out) + F.col("_keep") * F.col("_c_state")
        return self._with(joined.withColumn(out, total).drop("_keep", "_c_state"))

    def result(self) -> DataFrame:
        return self.df.drop("_pos", "_seg")


def lag_features(
    df: DataFrame, key: str, order: Sequence[str], column: str, names: dict[str, int], **sizes: int
) -> DataFrame:
    """Lags per key, gaps filled forward, then 0 (E01 + E02)."""
    frame = OrderedFrame.of(df, [key], order, **sizes)
    return frame.filled_lags(column, names).result().fillna(0.0, subset=list(names))


def centred_frame(rows: int) -> tuple[int, int]:
    """Rows before and after for a centred window of ``rows`` rows."""
    after = (rows - 1) // 2
    return rows - 1 - after, after


def rolling(
    df: DataFrame, column: str, rows: int, order: Sequence[str], keys: Sequence[str] = (),
    min_rows: int = 3, centred: bool = True, **sizes: int,
) -> DataFrame:
    """Rolling mean and sample deviation, NULL with fewer than ``min_rows`` values."""
    before, after = centred_frame(rows) if centred else (rows - 1, 0)

    def over(fn: Callable[[str], Column]) -> Callable[[WindowSpec], Column]:
        def make(w: WindowSpec) -> Column:
            frame = w.rowsBetween(-before, after)
            return F.when(F.count(column).over(frame) >= min_rows, fn(column).over(frame))
        return make

    columns = {"roll_mean": over(F.avg), "roll_std": over(F.stddev_samp)}
    return OrderedFrame.of(df, keys, order, **sizes).windows(columns, before, after).result()


def row_numbers(df: DataFrame, order: Sequence[str], out: str = "row_num") -> DataFrame:
    """Global 1-based row number without a single-task window."""
    return with_position(df, order, "_pos").withColumn(out, F.col("_pos") + 1).drop("_pos")
