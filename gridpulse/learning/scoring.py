"""Model artefacts on disk, and scoring of new rows in batch or per micro-batch."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.learning.fitted import CleaningModel
from gridpulse.learning.prepare import add_features, clean
from gridpulse.learning.training import Prepared, with_vector
from gridpulse.operators.cleaning import require_columns
from gridpulse.operators.joins import with_frequency
from gridpulse.schemas import DATASETS, Dataset
from gridpulse.streaming.state import last_values, with_series_state


@dataclass
class Artefacts:
    """A trained model with its encoder, scaler, frequency table and description."""

    spec: Dataset
    model: PipelineModel
    encoder: PipelineModel
    scaler: PipelineModel
    frequency: DataFrame
    numeric: list[str]
    metrics: dict[str, object]

    @classmethod
    def of(cls, spec: Dataset, data: Prepared, name: str, model: PipelineModel, metrics: DataFrame) -> Artefacts:
        row = metrics.filter(F.col("model") == name).first()
        described = {"model": name, "mae": row["mae"], "rmse": row["rmse"], "r2": row["r2"],
                     "trained_rows": data.train.count(), "features": data.feature_names}
        return cls(spec, model, data.encoder, data.scaler, data.frequency, data.numeric, described)

    def save(self, folder: str) -> None:
        for name in ("model", "encoder", "scaler"):
            getattr(self, name).write().overwrite().save(f"{folder}/{name}")
        self.frequency.write.mode("overwrite").parquet(f"{folder}/frequency")
        text = json.dumps({"dataset": self.spec.name, "numeric": self.numeric, "metrics": self.metrics})
        spark = self.frequency.sparkSession
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Artefacts:
        meta = json.loads(spark.read.text(f"{folder}/metadata").first()[0])
        parts = {name: PipelineModel.load(f"{folder}/{name}") for name in ("model", "encoder", "scaler")}
        frequency = spark.read.parquet(f"{folder}/frequency")
        return cls(DATASETS[meta["dataset"]], frequency=frequency, numeric=meta["numeric"], metrics=meta["metrics"], **parts)

    def metrics_table(self) -> DataFrame:
        """The metrics row as stored next to the predictions."""
        m = self.metrics
        spark = self.frequency.sparkSession
        rows = spark.createDataFrame(
            [(self.spec.name, m["model"], m["mae"], m["rmse"], m["r2"], m["trained_rows"], m["features"])],
            "dataset string, model string, mae double, rmse double, r2 double, trained_rows bigint, features array<string>")
        return rows.withColumn("trained_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))


def score(df: DataFrame, art: Artefacts, order: Sequence[str] | None = None) -> DataFrame:
    """Add the prediction to every row.

    All input columns stay on the row, so there is no row id and no join back.
    Lags come from ``order`` when the rows hold their own history, else from columns
    already present, else 0. Rows with a missing number are kept, not skipped.
    """
    spec = art.spec
    ready = add_features(require_columns(df, spec.required), spec, order)
    ready = with_frequency(ready, art.frequency, "area", "area_enc", stored=True)
    keep = [c for c in ready.columns if c != "area_enc"]
    predicted = art.model.transform(with_vector(ready, spec, art.encoder, art.scaler, art.numeric))
    return predicted.select(*keep, F.col("prediction").alias(spec.prediction))


def clean_and_score(df: DataFrame, art: Artefacts, order: Sequence[str] | None = None) -> DataFrame:
    """Raw readings to scored readings; the same function serves tables and micro-batches."""
    return score(clean(df, art.spec), art, order)


def score_stream(stream: DataFrame, art: Artefacts, cleaning: CleaningModel, history: DataFrame, order: Sequence[str],
                 wait: dt.timedelta = dt.timedelta(minutes=1)) -> DataFrame:
    """Streaming rows cleaned by fitted statistics, with real lags, and scored, in one query without jobs of its own.

    ``history``: cleaned earlier readings. The last values of each area are its first state, so the first streaming rows have the lags that a
    table of all rows would give them; ``order[0]`` must be ``timestamp``. Rows that come more than ``wait`` out of order are
    marked ``late`` and scored with lags of 0.
    """
    spec, ts = art.spec, order[0]
    cleaned = cleaning.transform(stream)
    cleaned = cleaned.withColumn(ts, F.col(ts).cast("timestamp"))
    first = last_values(history.withColumn(ts, F.col(ts).cast("timestamp")), "area", order, spec.target)
    series = with_series_state(cleaned, "area", order, spec.target, wait=wait, first=first)
    lags = {name: F.coalesce(F.col(f"lag{k}"), F.lit(0.0)) for name, k in spec.lags.items()}
    return score(series.withColumns(lags).drop("seq", "lag1", "lag2", "smooth"), art)


def batch_scorer(art: Artefacts, decode: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Transform for ``streaming.jobs.start_batches``: decode, clean, score."""
    return lambda batch: clean_and_score(decode(batch), art)
