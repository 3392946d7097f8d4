"""Join of moments with time ranges at full precision, as equi-joins on blocks and running figures within segments.

Time is cut into segments of a power of two units (microseconds, seconds); a range has segments that are not longer than it is, so it is up to three
pieces: from its begin to the end of that segment, whole segments, and from the begin of its last segment to its end. First and last pieces meet the
moments of their segment in one order by time, as running figures from either side; no piece is held against each moment. Whole segments are reduced
to one row for each first and last segment and then cut into the fewest blocks of a power of two that begin at a multiple of their size: at most two of
each size. A moment's segment lies in one block of each size and is looked up at the sizes that occur. So a range costs two rows and not some tens,
whatever its length and its ends, and what is left of it hangs on the segments that there are. Moments take part once for each size of segments.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from gridpulse.scratch import MAX_BROADCAST_ROWS, materialize

#: Sizes of segments are this many powers of two apart: a range has at most 2 ** STEP of its segments, or so many as ``SEGMENTS`` makes of it.
STEP = 6
#: Segments are not made longer than this part of the time in which most ranges lie: figures run within a segment of a key, in one task.
SEGMENTS = 1024


def blocks(low: Column, high: Column) -> Column:
    """Array of (level, block): the blocks that make up the units from ``low`` to ``high``, both included, from 0 on.

    A block of 2 ** level units is needed on the left where the range begins at an odd multiple of its size, on the right where it ends
    at an even one. What is left after that begins and ends at multiples of the next size.
    """
    levels = F.sequence(F.lit(0), F.length(F.bin(high + 1 - low)))

    def entries(i: Column) -> Column:
        a, b = F.call_function("shiftright", low - 1, i) + 1, F.call_function("shiftright", high + 1, i)  # in units of this level's size; b is not included
        # Where the last two units of a level are one block each, left and right are different ones; where one unit is left, the left one takes it
        # and the right one has b = a + 1, an even number then.
        found = [((a < b) & (a % 2 == 1), a), ((a < b) & (b % 2 == 1), b - 1)]
        return F.array(*[F.when(is_one, F.struct(i.alias("level"), block.cast("bigint").alias("block"))) for is_one, block in found])

    return F.filter(F.flatten(F.transform(levels, entries)), lambda x: x.isNotNull())


def range_blocks(ranges: DataFrame, keys: Sequence[str], low: str, high: str, measures: dict[str, Column]) -> DataFrame:
    """keys, level, block and the measures over all ranges that hold the block; ranges that end before they begin have none."""
    valid = ranges.where(F.col(low).isNotNull() & F.col(high).isNotNull() & (F.col(low) <= F.col(high)))
    cut = valid.withColumn("cut", F.explode(blocks(F.col(low), F.col(high))))
    return cut.groupBy(*keys, F.col("cut.level").alias("level"), F.col("cut.block").alias("block")).agg(*[m.alias(n) for n, m in measures.items()])


def total(*parts: Column) -> Column:
    """The sum of those that are not null, null if all are."""
    some = reduce(lambda x, y: x + y, [F.coalesce(p, F.lit(0)) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), some)


def _merged(name: str, combine: Callable[..., Column], kind: DataType, over: WindowSpec | None = None) -> Column:
    """The aggregate (over a window) that brings results of several rows together as ``combine`` does those of several columns."""
    over_rows = {F.greatest: F.max, F.least: F.min, total: F.sum}.get(combine, F.collect_list)(name)
    found = over_rows if over is None else over_rows.over(over)
    if combine not in (F.greatest, F.least, total):
        found = F.reduce(found, F.lit(None).cast(kind), lambda x, y: combine(x, y).cast(kind))
    return found.cast(kind)


def _looked_up(rows: DataFrame, at: Column, cut: DataFrame, keys: Sequence[str], how: dict[str, Callable[..., Column]], out: dict[str, str]) -> DataFrame:
    """``rows`` with the measures (named by ``out``) over the blocks of all sizes that hold ``at``.

    A size with few blocks is broadcast, by its count; the others are joined by (key, block), of which a key has many.
    """
    sizes = {r["level"]: r["count"] for r in cut.groupBy("level").count().collect()}  # a row for each size
    wide, found = rows, {n: [F.lit(None).cast(cut.schema[n].dataType)] for n in how}
    for level, n in sorted(sizes.items()):
        part = cut.where(F.col("level") == level).select(
            *[F.col(k).alias(f"_of{k}") for k in keys], F.col("block").alias("_block"), *[F.col(m).alias(f"_{m}_{level}") for m in how])
        on = F.shiftright(at, level) == F.col("_block")
        for k in keys:
            on = on & (F.col(k) == F.col(f"_of{k}"))
        wide = wide.join(F.broadcast(part) if n <= MAX_BROADCAST_ROWS else part, on, "left").drop("_block", *[f"_of{k}" for k in keys])
        for m in how:
            found[m].append(F.col(f"_{m}_{level}"))
    return wide.select(*rows.columns, *[combine(*found[m], found[m][0]).alias(out[m]) for m, combine in how.items()])


def _segment_sizes(spans: DataFrame) -> tuple[list[int], int]:
    """The powers of two of the segments that occur, and the highest there may be, by where most of the ranges lie."""
    length = F.col("_high") - F.col("_low") + 1
    step = F.floor((F.length(F.bin(length)) - 1) / STEP).cast("int")  # of the highest bit
    found, spread, mean = spans.agg(F.bit_or(F.call_function("shiftleft", F.lit(1), step)), F.stddev_pop("_low"), F.avg(length.cast("double"))).first()
    if found is None:
        return [], 0
    top = int((4 * spread + mean) / SEGMENTS).bit_length()
    return sorted({min(STEP * i, top) for i in range(found.bit_length()) if found >> i & 1}), top


def join_ranges(df: DataFrame, ranges: DataFrame, keys: Sequence[str], at: Column, low: str, high: str,
                measures: dict[str, tuple[Column, Callable[..., Column]]]) -> DataFrame:
    """``df`` with the measures over all ranges of its keys that hold ``at`` (low <= at <= high); null where none does. Rows are never multiplied.

    A measure is an aggregate of the ranges' columns and a function that brings the results of several pieces together, nulls left out
    (``F.max`` with ``F.greatest``, ``F.count`` with ``total``). ``low``, ``high`` and ``at`` are whole numbers from 0 on; a null key meets nothing.
    """
    ks = [f"_key_{i}" for i in range(len(keys))]
    how, first = {n: c for n, (_, c) in measures.items()}, [a.alias(n) for n, (a, _) in measures.items()]
    spans = ranges.withColumns({**{i: F.col(f"`{k}`") for i, k in zip(ks, keys)}, "_low": F.col(low).cast("bigint"), "_high": F.col(high).cast("bigint")})
    spans = spans.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in ks], F.col("_low") <= F.col("_high")))
    kinds = {n: spans.groupBy().agg(*first).schema[n].dataType for n in how}
    sizes, top = _segment_sizes(spans)
    if not sizes:
        return df.select("*", *[F.lit(None).cast(kinds[n]).alias(n) for n in how])

    def segment(c: str) -> Column:
        return F.call_function("shiftright", F.col(c), F.col("_bits"))

    bits = F.least(F.floor((F.length(F.bin(F.col("_high") - F.col("_low") + 1)) - 1) / STEP).cast("int") * STEP, F.lit(top))
    spans = spans.withColumn("_bits", bits).withColumns({"_begin": segment("_low"), "_end": segment("_high")})
    rows = df.withColumns({**{i: F.col(f"`{k}`") for i, k in zip(ks, keys)}, "_at": at.cast("bigint")})
    moments = materialize(rows.select(*ks, "_at").dropna().distinct(), "range-moments")
    moments = moments.withColumn("_bits", F.explode(F.array(*[F.lit(n) for n in sizes]))).withColumn("_segment", segment("_at"))
    ks_bits = [*ks, "_bits"]

    whole = spans.where("_end - _begin > 1").groupBy(*ks_bits, (F.col("_begin") + 1).alias("_a"), (F.col("_end") - 1).alias("_b")).agg(*first)
    whole = materialize(range_blocks(whole, ks_bits, "_a", "_b", {n: _merged(n, c, kinds[n]) for n, c in how.items()}), "range-blocks")
    segments = materialize(moments.select(*ks_bits, "_segment").distinct(), "range-segments")
    covered = _looked_up(segments, F.col("_segment"), whole, ks_bits, how, {n: f"_whole_{n}" for n in how})

    # A range in one segment is as long as that, so its first piece is all of it.
    pieces = F.array(F.struct(F.lit(True).alias("first"), F.col("_low").alias("at")),
                     F.when(F.col("_begin") < F.col("_end"), F.struct(F.lit(False).alias("first"), F.col("_high").alias("at"))))
    pieces = spans.withColumn("_piece", F.explode(pieces)).where(F.col("_piece").isNotNull())
    pieces = pieces.groupBy(*ks_bits, F.col("_piece.at").alias("_at"), F.col("_piece.first").alias("_first")).agg(*first)
    sides = {f"_{side}_{n}": F.when(F.col("_first") == (side == "first"), F.col(n)) for n in how for side in ("first", "last")}
    placed = pieces.select(*ks_bits, "_at", segment("_at").alias("_segment"), F.lit(False).alias("_moment"), *[c.alias(n) for n, c in sides.items()])
    placed = placed.unionByName(moments.withColumn("_moment", F.lit(True)), allowMissingColumns=True)
    of_segment = Window.partitionBy(*ks_bits, "_segment")
    for side, order in (("first", F.asc("_at")), ("last", F.desc("_at"))):  # equal times are in the frame
        w = of_segment.orderBy(order)
        placed = placed.withColumns({f"_{side}_{n}": _merged(f"_{side}_{n}", c, kinds[n], w) for n, c in how.items()})
    met = placed.where("_moment").join(covered, [*ks_bits, "_segment"], "left").select(
        *ks, "_at", *[c(*[F.col(f"_{part}_{n}") for part in ("first", "last", "whole")]).alias(f"_{n}") for n, c in how.items()])
    if len(sizes) > 1:
        met = met.groupBy(*ks, "_at").agg(*[_merged(f"_{n}", c, kinds[n]).alias(f"_{n}") for n, c in how.items()])
    met = met.withColumnsRenamed({c: f"_of{c}" for c in (*ks, "_at")})
    on = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_of{k}") for k in ks], F.col("_at") == F.col("_of_at"))
    return rows.join(met, on, "left").select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_{n}").alias(n) for n in how])
