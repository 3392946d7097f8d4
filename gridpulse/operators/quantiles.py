"""Approximate and exact quantiles, and exact cuts by rank."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.operators.ordered import MAX_GROUP_ROWS, OrderedFrame
from gridpulse.scratch import MAX_BROADCAST_ROWS, materialize

ACCURACY = 10_000


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (),
    accuracy: int = 1_000,
) -> DataFrame:
    """One array of quantiles per column, all in a single mergeable aggregation."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(F.nanvl(F.col(c), F.lit(None)), list(probs), accuracy).alias(c) for c in columns]
    )


def _interpolated(values: Column, p: float) -> Column:
    """Linear interpolation at ``p`` in a sorted array."""
    place = (F.size(values) - 1) * F.lit(p)
    at = F.floor(place).cast("int")
    low, high = F.get(values, at), F.get(values, F.least(at + 1, F.size(values) - 1))
    return F.when(F.size(values) > 0, low + (place - at) * (high - low))


def _direct(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Sort each group's values in memory; only for groups whose size has been checked."""
    arrays = df.groupBy(*keys).agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in columns])
    return arrays.select(*keys, *[
        F.array(*[_interpolated(F.col(c), float(p)) for p in probs]).alias(c) for c in columns
    ])


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles: ``keys`` plus one array per column.

    Groups of up to ``max_group_rows`` rows are sorted in one task each. For larger
    ones a sketch brackets each wanted rank, one scan counts what lies below the
    bracket, and only the few values inside it are ordered.
    """
    keys, columns = list(keys), list(columns)
    narrow = df.select(*keys, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    if not keys:
        if narrow.count() <= max_group_rows:
            return _direct(narrow, columns, probs, keys)
        return _bracketed(narrow, columns, probs, keys, max_group_rows)
    sizes = narrow.groupBy(*keys).agg(F.count("*").alias("_n"))
    big = materialize(sizes.filter(F.col("_n") > max_group_rows).select(*keys), "big")
    n_big = big.count()
    if n_big == 0:
        return _direct(narrow, columns, probs, keys)
    # At most rows / max_group_rows groups can be big.
    hint = F.broadcast(big) if n_big <= MAX_BROADCAST_ROWS else big
    same = [narrow[k].eqNullSafe(hint[k]) for k in keys]
    small = narrow.join(hint, same, "left_anti")
    large = narrow.join(hint, same, "left_semi")
    return _direct(small, columns, probs, keys).unionByName(
        _bracketed(large, columns, probs, keys, max_group_rows)
    )


def _bracketed(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: list[str], max_group_rows: int
) -> DataFrame:
    probs = [float(p) for p in probs]
    by = [*keys, "_column"]
    long = df.select(
        *keys,
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("_column"), F.col(c).alias("_v")) for c in columns
        ])).alias("_e"),
    ).select(*keys, "_e.*").filter(F.col("_v").isNotNull())
    # Twice the sketch's rank error, and the two neighbouring ranks of any group larger than the limit.
    margin = 2.0 / ACCURACY + 3.0 / max_group_rows
    low = [max(0.0, p - margin) for p in probs]
    high = [min(1.0, p + margin) for p in probs]
    sketch = long.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", low, ACCURACY).alias("_lo"),
        F.percentile_approx("_v", high, ACCURACY).alias("_hi"),
    )
    target = F.posexplode(F.array(*[F.lit(p) for p in probs]))
    targets = sketch.select("*", target.alias("_i", "_p")).select(
        *by, "_i",
        F.element_at("_lo", F.col("_i") + 1).alias("_lo"),
        F.element_at("_hi", F.col("_i") + 1).alias("_hi"),
        ((F.col("_n") - 1) * F.col("_p")).alias("_h"),
        (F.col("_n") - 1).alias("_top"),
    ).withColumn("_r0", F.floor("_h")).withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_top")))
    targets = materialize(targets, "targets")
    lookup = targets.select(*by, "_i", "_lo", "_hi")
    if targets.count() <= MAX_BROADCAST_ROWS:
        lookup = F.broadcast(lookup)
    r = lookup.select(*[F.col(c).alias(f"_k_{c}") for c in by], "_i", "_lo", "_hi")
    on = [long[c].eqNullSafe(r[f"_k_{c}"]) for c in by]
    # Rows above a bracket say nothing about its ranks; rows below only count.
    hits = long.join(r, on).filter(F.col("_v") <= F.col("_hi"))
    inside = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))
    counts = hits.groupBy(*by, "_i", inside.alias("_v")).agg(F.count("*").alias("_c"))
    counts = materialize(counts, "bracket")  # _v is NULL on the row that counts "below": sorted first
    run = OrderedFrame.of(counts, [*by, "_i"], ["_v"], max_group_rows).running_sum("_c", "_cum").result()
    t = targets.drop("_lo", "_hi", "_top")
    t = t.select(*[F.col(c).alias(f"_k_{c}") for c in [*by, "_i"]], "_h", "_r0", "_r1")
    t = F.broadcast(t) if t.count() <= MAX_BROADCAST_ROWS else t
    on = [run[c].eqNullSafe(t[f"_k_{c}"]) for c in [*by, "_i"]]
    ranked = run.join(t, on).filter(F.col("_v").isNotNull())
    stat = ranked.groupBy(*by, "_i").agg(
        F.min(F.when(F.col("_cum") > F.col("_r0"), F.col("_v"))).alias("_v0"),
        F.min(F.when(F.col("_cum") > F.col("_r1"), F.col("_v"))).alias("_v1"),
        F.first(F.col("_h") - F.col("_r0")).alias("_frac"),
    )
    value = F.col("_v0") + F.col("_frac") * (F.col("_v1") - F.col("_v0"))

    def pick(c: str) -> Column:
        return F.array(*[
            F.max(F.when((F.col("_column") == c) & (F.col("_i") == i), value)) for i in range(len(probs))
        ]).alias(c)

    found = stat.groupBy(*keys).agg(*[pick(c) for c in columns])
    if not keys:
        return found
    # A group without any value is a row of its own all the same.
    every = df.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    same = [found[k].eqNullSafe(every[f"_k_{k}"]) for k in keys]
    nothing = F.array(*[F.lit(None).cast("double")] * len(probs))
    return every.join(found, same, "left").select(
        *[F.col(f"_k_{k}").alias(k) for k in keys], *[F.coalesce(F.col(c), nothing).alias(c) for c in columns])


def rank_cut(
    df: DataFrame, order: Sequence[str], rank: int, max_group_rows: int = MAX_GROUP_ROWS
) -> list[object]:
    """Values of ``order`` on the row with 1-based ``rank`` (fewer columns if those decide).

    Column by column: bracket the rank with a sketch, count below, order only the
    bracket's distinct values. Every step brings one row to the driver.
    """
    cut: list[object] = []
    rows, left, total = df, rank, df.count()
    for c in order:
        kind = df.schema[c].dataType
        sketchable = isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
        below, inner = 0, rows
        missing = rows.filter(F.col(c).isNull()).count() if sketchable and total > max_group_rows else 0
        if missing and left <= missing:  # missing values come first
            inner = rows.filter(F.col(c).isNull())
        elif sketchable and total > max_group_rows:
            known = total - missing
            p, margin = (left - missing) / known, 2.0 / ACCURACY + 3.0 / known
            ends = rows.agg(F.percentile_approx(
                c, [max(0.0, p - margin), min(1.0, p + margin)], ACCURACY).alias("q")).first()["q"]
            lo, hi = F.lit(ends[0]).cast(kind), F.lit(ends[1]).cast(kind)
            below = missing + rows.filter(F.col(c) < lo).count()
            inner = rows.filter(F.col(c).between(lo, hi))
        counts = inner.groupBy(c).agg(F.count("*").alias("_c"))
        run = OrderedFrame.of(counts, [], [c], max_group_rows).running_sum("_c", "_cum").result()
        hit = run.filter(F.col("_cum") >= left - below).orderBy("_cum").limit(1).first()
        cut.append(hit[c])
        upto = below + hit["_cum"]
        left -= upto - hit["_c"]
        total = hit["_c"]
        if left == total:
            break
        rows = rows.filter(F.col(c).eqNullSafe(F.lit(hit[c]).cast(kind)))
    return cut


def at_or_before(df: DataFrame, order: Sequence[str], cut: Sequence[object]) -> Column:
    """Row comparison ``order <= cut``, missing values first, as a predicate the scan can push down."""
    condition = F.lit(True)
    for c, v in reversed(list(zip(order, cut))):
        if v is None:
            condition = F.col(c).isNull() & condition
            continue
        value = F.lit(v).cast(df.schema[c].dataType)
        condition = F.col(c).isNull() | (F.col(c) < value) | ((F.col(c) == value) & condition)
    return condition


def chronological_split(
    df: DataFrame, order: Sequence[str], fraction: float = 0.8, max_group_rows: int = MAX_GROUP_ROWS
) -> tuple[DataFrame, DataFrame]:
    """First ``int(rows * fraction)`` rows in ``order`` and the rest, without sorting the table."""
    first = int(df.count() * fraction)
    if first == 0:
        return df.limit(0), df
    early = at_or_before(df, order, rank_cut(df, order, first, max_group_rows))
    return df.filter(early), df.filter(~F.coalesce(early, F.lit(False)))


def last_rows(df: DataFrame, ts: str, tie: Sequence[str], n: int) -> DataFrame:
    """The ``n`` latest rows. A per-day count first finds the day from which on there
    are enough rows, so that the sort only sees those (and the scan prunes the rest)."""
    days = df.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("rows"))
    return latest_since(df, ts, tie, n, day_of_latest(days, n))


def day_of_latest(days: DataFrame, n: int) -> date | None:
    """The day from which on a table with ``rows`` per ``day`` has ``n`` rows; None where only rows without a day make up ``n``.

    One row a calendar day is summed up in one task; one value comes to the driver.
    """
    run = F.sum("rows").over(Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0))
    known = days.filter(F.col("day").isNotNull()).select("day", run.alias("upto"))
    return known.filter(F.col("upto") >= n).agg(F.max("day")).first()[0]


def latest_since(df: DataFrame, ts: str, tie: Sequence[str], n: int, day: date | None) -> DataFrame:
    """The ``n`` latest rows, looked for from ``day`` on."""
    recent = df if day is None else df.filter(F.col(ts) >= F.lit(day).cast(df.schema[ts].dataType))
    return recent.orderBy(F.desc(ts), *[F.desc(t) for t in tie]).limit(n)
