"""Cleaning and feature preparation, driven by a dataset description."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.calendar import with_calendar
from gridpulse.functions.constants import NAMED_DEFAULTS
from gridpulse.functions.predicates import split_columns
from gridpulse.operators import cleaning
from gridpulse.operators.ordered import lag_features
from gridpulse.schemas import Dataset
from gridpulse.scratch import materialize


def clean(df: DataFrame, spec: Dataset, store: bool = True) -> DataFrame:
    """Rename, default, de-duplicate, parse times, impute and cap.

    The de-duplicated rows are written once, because imputation means, modes and
    fences each scan a few of their columns and none should repeat the shuffle.
    """
    df = df.withColumnsRenamed(spec.rename).drop("generator_version")
    df = cleaning.named_defaults(df, NAMED_DEFAULTS)
    df = cleaning.drop_duplicates(df)
    df = with_calendar(cleaning.parse_time(df, "timestamp"))
    if store:
        df = materialize(df, f"{spec.name}-distinct")
    df = cleaning.impute(df, ["timestamp"], store)
    bounds = cleaning.iqr_bounds(df, [c for c in spec.capped if c in df.columns])
    return cleaning.cap_outliers(df, materialize(bounds, "bounds") if store else bounds)


def add_features(df: DataFrame, spec: Dataset, order: Sequence[str] | None = None, **sizes: int) -> DataFrame:
    """Row features, and lags of the target where ``order`` says how readings follow each other.

    Without an order (a stream with no history at hand) lags that are not there become 0.
    """
    df = spec.features(df)
    absent = {name: k for name, k in spec.lags.items() if name not in df.columns}
    if absent and order:
        return lag_features(df, "area", order, spec.target, absent, **sizes)
    return df.withColumns({name: F.lit(0.0) for name in absent})


def numeric_features(df: DataFrame, spec: Dataset, ignore: Sequence[str] = ()) -> list[str]:
    """Numeric columns the models use: all but the target, the encoded ones and those set aside."""
    skip = {spec.target, *spec.encoded, *spec.not_features, *spec.categorical, "area", "timestamp", *ignore}
    numeric, _ = split_columns(df, tuple(skip))
    return numeric
