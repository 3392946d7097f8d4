"""What several training-data operators share: table access, folds, hashing of words, connected groups."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.scratch import materialize

WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % parts


def give_back() -> None:
    """Return freed memory to the system: the driver trains on bounded samples, and its allocator would keep what that took at its most."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def hash_share(*columns: str) -> Column:
    """A fixed pseudo-random number in [0, 1) for each row, from its key columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def labelled_sample(df: DataFrame, label: str, keys: list[str], per_label: int | dict) -> DataFrame:
    """About ``per_label`` rows of each label (all, where there are fewer), chosen by a hash of the key columns.

    The exact counts give the share to keep, so the sample is the same for any partitioning, unless rows with equal keys had to be thinned.
    Training gathers it on the driver; ``per_label`` bounds it.
    """
    counts = {r[label]: r["count"] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if not counts:
        return df.limit(0)
    keep = F.lit(0.0)
    most = {value: per_label if isinstance(per_label, int) else per_label[value] for value in counts}
    for value, n in counts.items():
        keep = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, most[value] / n))).otherwise(keep)
    return thinned(df.where(F.col(label).isNotNull() & (hash_share(*keys) < keep)), label, most)


def thinned(df: DataFrame, label: str, most: dict) -> DataFrame:
    """``df``, or where one label has more than one and a half times its ``most`` rows, about ``most`` of them: rows with equal keys are kept or
    dropped together by a hash of the key, so a key on very many rows would go beyond any bound."""
    found = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    over = {value: n for value, n in found.items() if n > 1.5 * most[value] + 50}
    if not over:
        return df
    keep = F.lit(1.0)
    for value, n in over.items():
        keep = F.when(F.col(label) == F.lit(value), F.lit(most[value] / n)).otherwise(keep)
    return df.withColumn("row number", F.monotonically_increasing_id()).where(hash_share("row number") < keep).drop("row number")


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of a public-domain mixing function)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words(dict):
    """word -> its number here; unseen words get the next number. ``fresh`` lists those added since ``take()``."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n

    def take(self) -> list[str]:
        out, self.fresh = self.fresh, []
        return out

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Grown:
    """A numpy array that grows by doubling."""

    def __init__(self, dtype) -> None:
        self.data, self.size = np.empty(1024, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            bigger = np.empty(max(need, 2 * len(self.data)), self.data.dtype)
            bigger[: self.size] = self.data[: self.size]
            self.data = bigger
        self.data[self.size: need] = values
        self.size = need


def hash_words(words: Iterable[str]) -> np.ndarray:
    """64-bit hashes that are the same in every process: the code points as a polynomial, vectorised over all words."""
    words = list(words)
    if not words:
        return np.empty(0, np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lens)
    at = np.arange(len(points)) - np.repeat(ends - lens, lens)
    powers = _powers(int(lens.max(initial=0)) + 1)
    terms = mix(points + np.uint64(1)) * powers[at]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    return mix(sums[ends] - sums[ends - lens] + lens.astype(np.uint64))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _MIX, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHashes:
    """Words of a text as 64-bit hashes; each distinct word is hashed once until ``limit`` words are held."""

    def __init__(self, limit: int = 400_000) -> None:
        self.words, self.hashes, self.limit = Words(), Grown(np.uint64), limit

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.words) > self.limit:
            self.words, self.hashes = Words(), Grown(np.uint64)
        n = self.words.numbers(words)
        if self.words.fresh:
            self.hashes.extend(hash_words(self.words.take()))
        return self.hashes.data[n]


def shingles(word_hashes: np.ndarray, k: int = 5) -> np.ndarray:
    """The hashes of all runs of ``k`` words, in order; a shorter text is one run, a text without words has none."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(k, n)
    out = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        out = out * _MIX + word_hashes[i: n - width + 1 + i]
    return mix(out + np.uint64(width))


def connected(edges: DataFrame, a: str, b: str, label: str = "label", node: str = "node") -> DataFrame:
    """node, label: the smallest node that each node of an undirected graph reaches.

    Smallest labels travel along the edges and along earlier labels, one written table a round, until a round changes nothing. Every step
    is an aggregation with partial sums, so a node with very many edges is no hot task.
    """
    both = materialize(edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
                       .unionByName(edges.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct(), "edges")
    labels = materialize(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("l")), "labels")
    while True:
        near = both.join(labels.select(F.col("x").alias("y"), "l"), "y").groupBy("x").agg(F.min("l").alias("n"))
        far = labels.join(labels.select(F.col("x").alias("l"), F.col("l").alias("f")), "l").select("x", "f")
        step = materialize(
            labels.join(near, "x").join(far, "x").select("x", F.least("l", "n", "f").alias("l"),
                                                       (F.least("n", "f") < F.col("l")).alias("moved")), "labels")
        labels = step.drop("moved")
        if not step.where("moved").limit(1).count():
            return labels.select(F.col("x").alias(node), F.col("l").alias(label))
