"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are trained by follow-the-regularised-leader with an elastic-net penalty (per-coordinate rates, exact zeros) on a bounded, hashed
sample of labelled documents, then one temperature is fitted on the part of the sample kept out of training. Document frequencies are counted
over every training document. Prediction reads the whole text.

Cases: a null text or one without a letter is ``und`` with score 0; rows with a null label are not learned from; repeated rows get equal
results; equal probabilities go to the language first in alphabetical order; with no labelled row at all everything is ``und``; an empty
table gives an empty result; columns that are not named are ignored or carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import give_back, labelled_sample

UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # features x languages, mostly zero
    bias: np.ndarray
    idf: np.ndarray
    temperature: float


def letter_flags() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str, letters: np.ndarray, features: int, longest: int = 3) -> np.ndarray | None:
    """Hashed n-grams of the lower-cased letters, each run of anything else as one space; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, np.uint32(32))
    keep = np.ones(len(points), bool)
    keep[1:] = is_letter[1:] | is_letter[:-1]
    points = points[keep]
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]]).astype(np.uint32)
    out, h = [], np.zeros(len(points), np.uint32)
    shift = np.uint32(32 - (features.bit_length() - 1))  # the number of features is a power of two
    for n in range(1, longest + 1):
        h = h[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1:]
        out.append(((h ^ (h >> np.uint32(15)) ^ np.uint32(n << 24)) * np.uint32(0x9E3779B1)) >> shift)
    return np.concatenate(out)


def tf_idf(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log term frequency times inverse document frequency, to unit length."""
    x = np.bincount(found, minlength=len(idf)).astype(np.float32)
    np.log1p(x, out=x)
    x *= idf
    return x / max(float(np.sqrt(x @ x)), 1e-9)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(-1, keepdims=True))
    return z / z.sum(-1, keepdims=True)


def train(texts: list[str], labels: list[str], idf: np.ndarray, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02,
          l2: float = 0.5, epochs: int = 4, seed: int = 5) -> Model:
    """FTRL-proximal, one document a step; every fifth document is kept for the temperature."""
    features, letters = len(idf), letter_flags()
    rows = []  # the n-grams of one text at a time: those of all are some ten times the texts
    for t, y in zip(texts, labels):
        if (g := grams(t, letters, features)) is not None:
            x = tf_idf(g, idf)
            at = np.flatnonzero(x)
            rows.append((at.astype(np.int32), x[at], y))
    names = tuple(sorted({y for _, _, y in rows}))
    if not names:
        return Model((), np.zeros((features, 0)), np.zeros(0), idf, 1.0)
    sparse = [(at, x, names.index(y)) for at, x, y in rows]
    held = [s for i, s in enumerate(sparse) if i % 5 == 4]
    used = [s for i, s in enumerate(sparse) if i % 5 != 4]
    k = len(names)
    z, n = np.zeros((features + 1, k)), np.zeros((features + 1, k))  # the last row is the bias

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(used)):
            at, x, y = used[i]
            at, x = np.append(at, features), np.append(x, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            squares = g * g
            z[at] += g - (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / alpha * w
            n[at] += squares
    w = weights(np.arange(features + 1))
    logits = np.array([x @ w[at] + w[-1] for at, x, _ in held or used])
    truth = np.array([y for _, _, y in held or used])
    return Model(names, w[:-1].astype(np.float32), w[-1], idf, temperature(logits, truth))


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the logits with the smallest log loss, by golden-section search on its logarithm."""
    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -float(np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-300)).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def document_frequencies(docs: DataFrame, text_column: str, features: int) -> tuple[np.ndarray, int]:
    """In how many of all documents each hashed n-gram occurs; a task sends one number for each feature it saw."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, total, df = letter_flags(), 0, np.zeros(features, np.int64)
        seen = np.zeros(features, np.uint8)
        for batch in batches:
            for text in batch.column(text_column):
                text = text.as_py()
                found = grams(text, letters, features) if text else None
                if found is not None:
                    seen[found] = 1
                    df += seen
                    seen[:] = 0
                    total += 1
        if total:
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_pydict({"feature": pa.array(np.append(at, -1), pa.int32()),
                                              "n": pa.array(np.append(df[at], total), pa.int64())})

    rows = docs.select(text_column).mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # at most one row for each feature
    at, n = found.column("feature").to_numpy(), found.column("n").to_numpy()
    df = np.zeros(features, np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return df, int(n[at < 0].sum())


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang",
        per_language: int = 1200, features: int = 1 << 15, **parameters) -> Model:
    """Learn from ``labelled``: document frequencies from all of it, weights from about ``per_language`` documents of each language."""
    usable = labelled.where(F.col(label_column).isNotNull() & F.col(text_column).isNotNull())
    df, total = document_frequencies(usable, text_column, features)
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + np.float32(1)
    frame = usable.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"), F.col(label_column).cast("string").alias("y"))
    rows = labelled_sample(frame, "y", ["id", "t"], per_language).collect()
    rows.sort(key=lambda r: (r["id"] is None, r["id"], r["t"], r["y"]))
    texts, labels = [r["t"] for r in rows], [r["y"] for r in rows]
    del rows
    model = train(texts, labels, idf, **parameters)
    del texts
    give_back()
    return model


def predict(docs: DataFrame, model: Model, text_column: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs``, the language and its calibrated probability."""
    base = docs.drop(into, score)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in base.schema)}, `{into}` string, `{score}` double"
    held = docs.sparkSession.sparkContext.broadcast(model)  # features x languages numbers, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, letters = held.value, letter_flags()
        for batch in batches:
            names, scores = [], []
            for text in batch.column(text_column):
                text = text.as_py()
                found = grams(text, letters, len(m.idf)) if text and m.languages else None
                if found is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = softmax((tf_idf(found, m.idf) @ m.weights + m.bias) / m.temperature)
                names.append(m.languages[int(p.argmax())])
                scores.append(float(p.max()))
            table = pa.Table.from_batches([batch]).append_column(into, pa.array(names, pa.string()))
            yield from table.append_column(score, pa.array(scores, pa.float64())).to_batches()

    return base.mapInArrow(run, schema)
