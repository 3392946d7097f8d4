"""View filters, sampling, melting, unions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.operators.quantiles import last_rows


def day_end(day: date | datetime) -> datetime:
    """A bare date ends at 23:59:59."""
    if isinstance(day, datetime):
        return day
    return datetime.combine(day, time.min) + timedelta(days=1) - timedelta(seconds=1)


def apply_filters(
    df: DataFrame, areas: Sequence[str] = (), zones: Sequence[str] = (), seasons: Sequence[str] = (),
    start: date | datetime | None = None, end: date | datetime | None = None, ts: str = "timestamp",
) -> DataFrame:
    """View filter; an empty choice keeps everything, bounds are inclusive.

    Bounds are cast to the column's own type, so the comparison stays a plain
    column-to-literal one that reaches the scan.
    """
    for column, chosen in (("area", areas), ("zone", zones), ("season", seasons)):
        if chosen and column in df.columns:
            df = df.filter(F.col(column).isin(list(chosen)))
    if ts in df.columns:
        kind = df.schema[ts].dataType
        if start is not None:
            df = df.filter(F.col(ts) >= F.lit(start).cast(kind))
        if end is not None:
            df = df.filter(F.col(ts) <= F.lit(day_end(end)).cast(kind))
    return df


def time_bounds(tables: Sequence[DataFrame], ts: str = "timestamp") -> DataFrame:
    """Earliest and latest time over several tables: one partial min/max per table."""
    per_table = [t.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")) for t in tables]
    both = reduce(DataFrame.unionByName, per_table)
    return both.agg(F.min("lo").alias("min_ts"), F.max("hi").alias("max_ts"))


def with_prediction(filtered: DataFrame, raw: DataFrame, column: str) -> DataFrame | None:
    """Rows that carry a prediction; the unfiltered stream rows if the filter leaves none."""
    if column in filtered.columns:
        rows = filtered.dropna(subset=[column])
        if not rows.isEmpty():
            return rows
    return raw.dropna(subset=[column]) if column in raw.columns else None


def fixed_sample(df: DataFrame, key: str, n: int, seed: int, digest: str = "xxhash64") -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones every time: the ``n`` smallest key hashes."""
    if digest == "md5":
        rank = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    else:
        rank = F.xxhash64(F.col(key), F.lit(seed))
    return df.orderBy(rank, key).limit(n)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def merge_batches(batches: Sequence[DataFrame]) -> DataFrame | None:
    return reduce(DataFrame.unionByName, batches) if batches else None


def merge_history(
    history: DataFrame | None, recent: DataFrame | None, ts: str, tie: Sequence[str], keep: int | None = None
) -> DataFrame | None:
    """History and stream rows in time order; with ``keep``, only the latest rows of the history."""
    parts = []
    if history is not None:
        parts.append(history if keep is None else last_rows(history, ts, tie, keep))
    if recent is not None:
        parts.append(recent)
    if not parts:
        return None
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.orderBy(ts, *tie)


def select_once(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name (ignoring case), as files cannot hold both."""
    seen: set[str] = set()
    names, keep = [], []
    for i, name in enumerate(df.columns):
        names.append(f"_{i}")
        if name.lower() not in seen:
            seen.add(name.lower())
            keep.append((f"_{i}", name))
    renamed = df.toDF(*names)
    return renamed.select(*[F.col(tmp).alias(name) for tmp, name in keep])
