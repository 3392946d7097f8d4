"""Cleaning fitted on history: means, modes and fences as a stage that is saved with the models and applied to single rows.

``prepare.clean`` takes its statistics from the rows it cleans, which on a stream would be those of one micro-batch. ``Cleaning`` takes them once
from a history; the model holds a few numbers for each column, so it needs no job, no shuffle and no stored table, works on streaming
rows, and gives a row the same result in any batch. Repeated rows are for the stream's own de-duplication; in fitting they count once.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gridpulse.functions.calendar import with_calendar
from gridpulse.functions.constants import NAMED_DEFAULTS
from gridpulse.functions.predicates import is_measure, nan_to_null, null_like
from gridpulse.operators import cleaning
from gridpulse.schemas import DATASETS, Dataset
from gridpulse.scratch import materialize


def _readable(df: DataFrame, spec: Dataset) -> DataFrame:
    """The row-wise first part: names, named defaults, times, calendar. Rows whose time does not parse go."""
    df = df.withColumnsRenamed(spec.rename).drop("generator_version")
    return with_calendar(cleaning.parse_time(cleaning.named_defaults(df, NAMED_DEFAULTS), "timestamp"))


class _Named(Params):
    dataset = Param(Params._dummy(), "dataset", "name of the dataset description", TypeConverters.toString)

    @property
    def spec(self) -> Dataset:
        return DATASETS[self.getOrDefault("dataset")]


class CleaningModel(Model, _Named, DefaultParamsReadable, DefaultParamsWritable):
    """``means`` and ``modes`` of columns for missing values, then ``fences`` (lower, upper) for outliers."""

    means = Param(Params._dummy(), "means", "column -> mean, none where it has no valid value", TypeConverters.identity)
    modes = Param(Params._dummy(), "modes", "column -> most frequent text", TypeConverters.identity)
    fences = Param(Params._dummy(), "fences", "column -> [lower, upper]", TypeConverters.identity)

    def statistics(self) -> dict[str, dict]:
        return {name: self.getOrDefault(name) for name in ("means", "modes", "fences")}

    def _transform(self, df: DataFrame) -> DataFrame:
        df = _readable(df, self.spec)
        means, modes, fences = self.statistics().values()
        filled: dict[str, Column] = {}
        for c in df.columns:
            if means.get(c) is not None:
                filled[c] = F.coalesce(nan_to_null(c), F.lit(means[c]))
            elif modes.get(c) is not None:
                filled[c] = F.when(null_like(c), F.lit(modes[c])).otherwise(F.col(c))
        df = df.withColumns(filled)
        capped = {c: F.when(F.col(c) < low, F.lit(low)).when(F.col(c) > high, F.lit(high)).otherwise(F.col(c))
                  for c, (low, high) in fences.items() if c in df.columns and low is not None}
        return df.withColumns(capped)


class Cleaning(Estimator, _Named, DefaultParamsReadable, DefaultParamsWritable):
    """``exact``: fences from exact quartiles, else from mergeable sketches."""

    exact = Param(Params._dummy(), "exact", "exact quartiles", TypeConverters.toBoolean)

    def __init__(self, dataset: str | None = None, exact: bool = False) -> None:
        super().__init__()
        self._set(exact=exact, **({"dataset": dataset} if dataset else {}))

    def _fit(self, history: DataFrame) -> CleaningModel:
        spec = self.spec
        rows = materialize(_readable(cleaning.drop_duplicates(history), spec), f"{spec.name}-history")
        fields = [f for f in rows.schema.fields if f.name != "timestamp"]
        measures = [f.name for f in fields if is_measure(f)]
        texts = [f.name for f in fields if isinstance(f.dataType, StringType)]
        means = rows.agg(*[F.avg(nan_to_null(c)).alias(c) for c in measures]).first().asDict() if measures else {}
        modes = {r["column"]: r["mode"] for r in cleaning.modes(rows, texts).collect()} if texts else {}  # a row for each text column
        model = CleaningModel()._set(dataset=spec.name, means=means, modes=modes, fences={})
        capped = [c for c in spec.capped if c in measures and means.get(c) is not None]
        if capped:
            found = cleaning.iqr_bounds(model.transform(rows), capped, exact=self.getOrDefault("exact")).first()
            model._set(fences={c: [found[c]["lower"], found[c]["upper"]] for c in capped})
        return model
