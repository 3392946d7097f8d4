"""Toxicity by subword-bag embeddings: averaged vectors of words and their character n-grams under a linear softmax.

A text is toxic when some passage of it is. For each width in ``windows`` (a word alone, a passage) words are averaged over windows of that
many, and a document takes its highest window, so a few words count as much in a very long text as in a short one. One linear softmax takes
the averages of all widths, each with weights of its own: single words speak through the narrow one, phrases of words that are harmless
elsewhere through the wide one. Embeddings and output layer are trained together in numpy on a bounded, hashed sample of labelled documents;
scoring covers every word of every document. Subwords of few sampled documents are trained too, in steps that are the smaller the fewer they
are (``rare``).

Cases: a null or empty text, or one without words, has one empty window and gets the bias alone; null labels are not learned from; repeated
rows score alike; without any label of one of the two classes every score is that of the other class (0 without labels). Columns other than
the named ones are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import WORD, Grown, Words, give_back, hash_words, labelled_sample, thinned


@dataclass(frozen=True)
class Model:
    """``vectors`` of the hashed subwords, ``out`` (widths x dim x 2) and ``bias`` of the softmax."""

    vectors: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    windows: tuple[int, ...]
    constant: float | None = None

    def direction(self) -> np.ndarray:
        """Each subword's own share of the difference of the two logits, one row a width."""
        return _direction(self.vectors, self.out)


def subwords(words: list[str], buckets: int, low: int = 3, high: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Of every word's n-grams and of the word itself: the number of the word and the bucket. All words are hashed together."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lens)
    of = np.repeat(np.arange(len(words)), lens)
    left = ends[of] - np.arange(len(points))  # characters to the end of the word
    size = lens[of]
    owners, hashes, h = [np.arange(len(words))], [hash_words(words) >> np.uint64(32)], np.zeros(len(points), np.uint32)
    for n in range(1, high + 1):
        h = h[: len(points) - n + 1] * np.uint32(0x01000193) + points[n - 1:]
        if n >= low:
            at = np.flatnonzero((left[: len(h)] >= n) & (size[: len(h)] > n))
            owners.append(of[at])
            hashes.append(((h[at] ^ (h[at] >> np.uint32(15)) ^ np.uint32(n)) * np.uint32(0x9E3779B1)).astype(np.uint64))
    return np.concatenate(owners), (np.concatenate(hashes) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _window_sums(values: np.ndarray, window: int) -> np.ndarray:
    """Means of ``values`` over each run of ``window``, or over all of a shorter text."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    width = max(1, min(window, len(values)))
    return (sums[width:] - sums[:-width]) / width if len(values) else np.zeros(1)


def _direction(vectors: np.ndarray, out: np.ndarray) -> np.ndarray:
    return (out[:, :, 1] - out[:, :, 0]).astype(np.float32) @ vectors.T


def train(texts: list[str], labels: list[int], windows: tuple[int, ...] = (1, 8), dim: int = 8, buckets: int = 1 << 18, epochs: int = 12,
          rate: float = 0.5, seed: int = 7, batch_docs: int = 32, least_steps: int = 800,
          damping: float = 1e-5, rare: float = 2.0) -> Model:
    """Adagrad on the loss of each document's highest window; the first epoch averages whole documents. A small sample is gone through more
    often than ``epochs`` times, until there were ``least_steps`` steps."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out, bias = np.zeros((len(windows), dim, 2)), np.zeros(2)
    out[:, :, 1] = rng.uniform(-0.5, 0.5, dim)
    out[:, :, 0] = -out[:, :, 1]
    y = np.asarray(labels, np.int64)
    if len(y) == 0 or y.min() == y.max():
        return Model(vectors[:1], out, bias, windows, float(y[0]) if len(y) else 0.0)
    words = Words()
    docs = [words.numbers(WORD.findall(t.lower())).astype(np.int32) for t in texts]
    buckets_of, sizes, fresh = [], [], words.take()
    for at in range(0, len(fresh), 20_000):
        owner, found = subwords(fresh[at: at + 20_000], buckets)
        buckets_of.append(found[np.argsort(owner, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(owner))
    buckets_of, sizes = np.concatenate([*buckets_of, np.empty(0, np.int32)]), np.concatenate([*sizes, np.empty(0, np.int64)])
    ends = np.cumsum(sizes)
    del fresh, words
    # Subwords of very few documents would learn those documents by heart at full steps; those of no document keep the zero vector.
    seen = np.zeros(buckets, np.int32)
    for d in docs:
        own = np.unique(d)
        n = sizes[own]
        starts = np.cumsum(n) - n
        seen[np.unique(buckets_of[np.repeat(ends[own] - n - starts, n) + np.arange(n.sum())])] += 1
    trust = (seen / (seen + rare)).astype(np.float32)
    vectors *= trust[:, None]
    squared, out_sq, bias_sq = np.full(buckets, damping), np.full(out.shape, 1e-6), np.full(2, 1e-6)
    weight = np.array([1.0, np.sqrt((y == 0).sum() / (y == 1).sum())])

    def grams(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = sizes[numbers]
        starts = np.cumsum(n) - n
        return buckets_of[np.repeat(ends[numbers] - n - starts, n) + np.arange(n.sum())], n

    batches = max(1, len(docs) // batch_docs)
    epochs = max(epochs, -(-least_steps // batches))
    for epoch in range(epochs):
        scalars = [np.add.reduceat(share, ends - sizes) / sizes if len(sizes) else share
                   for share in (row[buckets_of] for row in _direction(vectors, out))]
        step = rate * (1 - 0.8 * epoch / epochs)
        for batch in np.array_split(rng.permutation(len(docs)), batches):
            taken = []
            for scalar, window in zip(scalars, windows):
                for d in batch:
                    if len(docs[d]) <= window or epoch < 1:
                        taken.append(docs[d])
                    else:
                        at = int(np.argmax(_window_sums(scalar[docs[d]], window)))
                        taken.append(docs[d][at: at + window])
            lens = np.array([len(t) for t in taken])
            if not lens.sum():
                continue
            uniq, back = np.unique(np.concatenate(taken), return_inverse=True)
            g, n = grams(uniq)
            starts = np.cumsum(n) - n
            word_vec = np.add.reduceat(vectors[g], starts) / n[:, None]
            of = np.repeat(np.arange(len(taken)), lens)
            sums = np.stack([np.bincount(of, word_vec[back, k], len(taken)) for k in range(dim)], 1)
            mean = (sums / np.maximum(lens, 1)[:, None]).reshape(len(windows), len(batch), dim)
            logits = (mean @ out).sum(0) + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            delta = p.copy()
            delta[np.arange(len(batch)), y[batch]] -= 1
            delta *= weight[y[batch]][:, None] / len(batch)
            to_mean = (delta @ out.transpose(0, 2, 1)).reshape(-1, dim) / np.maximum(lens, 1)[:, None]
            to_word = np.stack([np.bincount(back, to_mean[of, k], len(uniq)) for k in range(dim)], 1) / n[:, None]
            gu, gb = np.unique(g, return_inverse=True)
            rep = np.repeat(to_word, n, axis=0)
            grad = np.stack([np.bincount(gb, rep[:, k], len(gu)) for k in range(dim)], 1)
            squared[gu] += (grad ** 2).mean(1)
            vectors[gu] -= (step * grad / np.sqrt(squared[gu])[:, None] * trust[gu, None]).astype(np.float32)
            go, gbias = mean.transpose(0, 2, 1) @ delta, delta.sum(0)
            out_sq += go ** 2
            bias_sq += gbias ** 2
            out -= 0.2 * step * go / np.sqrt(out_sq)
            bias -= 0.2 * step * gbias / np.sqrt(bias_sq)
    return Model(vectors, out, bias, windows)


class Scorer:
    """Scores texts with the subword shares of a model; each distinct word is looked up once until ``limit`` are held."""

    def __init__(self, share: np.ndarray, bias: float, windows: tuple[int, ...], constant: float | None, limit: int = 300_000) -> None:
        self.share, self.bias, self.windows, self.constant, self.limit = share, bias, windows, constant, limit
        self.words, self.values = Words(), [Grown(np.float64) for _ in windows]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if len(self.words) > self.limit:
            self.words, self.values = Words(), [Grown(np.float64) for _ in self.windows]
        docs = [self.words.numbers(WORD.findall(t.lower()) if t else []) for t in texts]
        if fresh := self.words.take():
            for at in range(0, len(fresh), 50_000):
                owner, g = subwords(fresh[at: at + 50_000], self.share.shape[1])
                n = np.bincount(owner)
                for values, share in zip(self.values, self.share):
                    values.extend(np.bincount(owner, share[g]) / n)
        best = self.bias + sum(np.array([_window_sums(values.data[d], window).max() for d in docs])
                               for values, window in zip(self.values, self.windows))
        return 1 / (1 + np.exp(-np.clip(best, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
        most_clean: int = 4000, most_toxic: int = 1500, **parameters) -> Model:
    """Train on about ``most_clean`` and ``most_toxic`` of the documents that ``labels`` marks 0 or 1 (the bound on what the driver gathers)."""
    usable = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    most = {0: most_clean, 1: most_toxic}
    sample = labelled_sample(usable, "y", ["id"], most)  # bounded, so it can be broadcast
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("t"))
    rows = thinned(texts.join(F.broadcast(sample), "id"), "y", most).collect()  # an id may have many rows
    rows.sort(key=lambda r: (r["id"], r["t"], r["y"]))
    texts, labels = [r["t"] for r in rows], [r["y"] for r in rows]
    del rows
    model = train(texts, labels, **parameters)
    del texts
    give_back()
    return model


def score(docs: DataFrame, model: Model, text_column: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``into``, the probability of label 1."""
    share, bias = model.direction().astype(np.float32), float(model.bias[1] - model.bias[0])
    held = docs.sparkSession.sparkContext.broadcast(share)  # its size is the bucket count, whatever the data
    windows, constant = model.windows, model.constant
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in docs.drop(into).schema)}, `{into}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value, bias, windows, constant)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                table = pa.Table.from_batches([part])
                values = pa.array(scorer(part.column(text_column).to_pylist()), pa.float64())
                yield from table.append_column(into, values).to_batches()

    return docs.drop(into).mapInArrow(run, schema)
