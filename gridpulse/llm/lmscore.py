"""Language-model scores of whole documents: a gated recurrent model with class-factored output over the corpus's own word counts.

1. Documents are dealt over blocks by a hash of their id and text. Each block counts its words; totals over all training documents come from one shuffle by
   word and go back to the blocks that have the word.
2. The most frequent words are head words of the model. Every other word belongs to the class of its last two bytes (the most frequent such
   endings, and one for the rest) and has its count's share of that class.
3. The model starts from the counts, is warmed up on the driver with a bounded sample, and is then trained where the documents are: every
   word of every training document takes part once, in consecutive windows with the state carried over the document (over each ``longest``
   words of a longer one, so that one document does not fill a lane for long). Each task trains its own copy, and the copies are
   averaged, ``rounds`` times, each time on another part of the documents.
4. Each document is scored whole, its state carried across windows.

``base_score`` is the add-one unigram score of the same words. Cases: a null or empty text is its end alone; a repeated row is scored, and counted, each time; a null id
is the empty text for the fold; with no training document N and V are zero and every word is unseen; ties of counts go to the smaller
word; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm import gru
from gridpulse.llm.common import Words, fold, hash_share, thinned
from gridpulse.scratch import materialize

END = b" "  # no word contains a blank


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased A-Z, cut at blanks and the control characters 9 to 13, then the end."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END] if text else [END]


@dataclass
class Vocabulary:
    """Symbols: head words, then one for each ending class. ``sums`` and ``kinds``: count and number of words of each ending class."""

    head: dict[bytes, int]
    endings: dict[bytes, int]
    sums: np.ndarray
    kinds: np.ndarray
    total: int
    distinct: int
    head_counts: np.ndarray

    @property
    def head_classes(self) -> int:
        return -(-len(self.head) // gru.CLASS_WORDS)

    def symbols(self, words: list[bytes], counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Symbol, class, number in the class and natural log share of the class of each word."""
        n, heads = len(self.head), self.head_classes
        symbol = np.fromiter((self.head.get(w, -1) for w in words), np.int64, len(words))
        ending = np.fromiter((self.endings.get(w[-2:], 0) for w in words), np.int64, len(words))
        is_head = symbol >= 0
        cls = np.where(is_head, symbol // gru.CLASS_WORDS, heads + ending)
        share = np.zeros(len(words))
        if counts is not None:
            share = np.where(is_head, 0.0, np.log((counts + 1) / (self.sums[ending] + self.kinds[ending] + 1)))
        return np.where(is_head, symbol, n + ending), cls, np.where(is_head, symbol % gru.CLASS_WORDS, 0), share


def block_counts(docs: DataFrame) -> DataFrame:
    """block, word, c (count in all training documents), once (true in one of the word's blocks)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, train, other = None, Counter(), set()

        def out() -> Iterator[pa.RecordBatch]:
            for word in other:
                train.setdefault(word, 0)
            words, n = list(train), np.fromiter(train.values(), np.int64, len(train))
            for i in range(0, len(words), 200_000):
                part = words[i: i + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), at)), pa.array(part, pa.binary()), pa.array(n[i: i + 200_000])],
                                                 names=["block", "word", "n"])

        for batch in batches:
            for block, text, learn in zip(batch.column("block").to_pylist(), batch.column("text"), batch.column("learn").to_pylist()):
                if block != at:
                    if at is not None:
                        yield from out()
                    at, train, other = block, Counter(), set()
                words = words_of(text.as_py())
                if learn:
                    train.update(words)
                else:
                    other.update(words)
        if at is not None:
            yield from out()

    found = docs.repartition("block").sortWithinPartitions("block").mapInArrow(run, "block long, word binary, n long")
    word = Window.partitionBy("word")  # a word has one row for each block
    return found.select("block", "word", F.sum("n").over(word).alias("c"), (F.min("block").over(word) == F.col("block")).alias("once"))


def vocabulary(counted: DataFrame, head_words: int, endings: int) -> Vocabulary:
    """Statistics of all training words; what reaches the driver is bounded by ``head_words`` and the number of two-byte endings."""
    known = counted.where("once and c > 0")
    total, distinct = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    rows = known.orderBy(F.desc("c"), "word").limit(head_words).select("word", "c").collect()
    head = {bytes(r["word"]): i for i, r in enumerate(rows)}
    tops = counted.sparkSession.createDataFrame([(w,) for w in head], "word binary")
    tail = known.join(F.broadcast(tops), "word", "left_anti").groupBy(F.expr("right(hex(word), 4)").alias("e")).agg(
        F.sum("c").alias("n"), F.count("*").alias("k")).collect()  # at most 65,536 + 256 endings
    tail.sort(key=lambda r: (-r["n"], r["e"]))
    named = {bytes.fromhex(r["e"]): i + 1 for i, r in enumerate(tail[:endings])}
    sums, kinds = np.zeros(endings + 1), np.zeros(endings + 1)
    for i, r in enumerate(tail):
        sums[i + 1 if i < endings else 0] += r["n"]
        kinds[i + 1 if i < endings else 0] += r["k"]
    return Vocabulary(head, named, sums, kinds, int(total), int(distinct), np.array([r["c"] for r in rows], np.float64))


def stretches(texts: list[tuple[int | None, str | None]], v: Vocabulary, stretch: int) -> tuple[np.ndarray, ...]:
    """Padded inputs, classes, words and lengths: from each document a run of words that starts at a place given by its id's hash."""
    parts = []
    for doc, text in texts:
        words = words_of(text)
        room = len(words) - stretch
        at = zlib.crc32(f"at {doc}".encode()) % (room + 1) if room > 0 else 0
        parts.append((at, words[max(0, at - 1): at + stretch]))
    flat = [w for _, p in parts for w in p]
    symbol, cls, word, _ = v.symbols(flat, None)
    shape, begin = (len(parts), stretch), len(v.head) + len(v.endings) + 1
    inputs, classes, words, lens = np.full(shape, begin), np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(len(parts), np.int64)
    i = 0
    for row, (at, p) in enumerate(parts):
        lead = 1 if at else 0  # the word before the stretch is its first input
        n = len(p) - lead
        classes[row, :n], words[row, :n] = cls[i + lead: i + len(p)], word[i + lead: i + len(p)]
        inputs[row, 1 - lead: n] = symbol[i: i + len(p) - 1]
        lens[row] = n
        i += len(p)
    return inputs, classes, words, lens


def train_on(w: gru.Weights, texts: Iterator[list[tuple[int | None, str | None]]], v: Vocabulary, stretch: int, rate: float) -> tuple[gru.Weights, int]:
    trainer, seen = gru.Trainer(w, rate=rate), 0
    for part in texts:
        inputs, classes, words, lens = stretches(part, v, stretch)
        trainer.sequences(inputs, classes, words, lens)
        seen += len(part)
    return trainer.w, seen


def walks(texts: Iterator[list[str | None]], v: Vocabulary, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Inputs, classes and words of every document, whole; those of more than ``longest`` words in several pieces one after another."""
    begin = len(v.head) + len(v.endings) + 1
    for part in texts:
        number = Words()
        docs = [number.numbers(words_of(text)) for text in part]
        symbol, cls, word, _ = v.symbols(number.take(), None)
        for own in docs:
            inputs = np.append(begin, symbol[own[:-1]])
            for at in range(0, len(own), longest):
                piece = slice(at, at + longest)
                yield inputs[piece], cls[own[piece]], word[own[piece]]


def train_whole(w: gru.Weights, texts: Iterator[list[str | None]], v: Vocabulary, rate: float, lanes: int, longest: int) -> tuple[gru.Weights, int]:
    """The weights after one pass over all words of the texts, and how many they were."""
    trainer = gru.Trainer(w, rate=rate)
    seen = trainer.walk(gru.windows_of(walks(texts, v, longest), lanes, trainer.window), lanes)
    return trainer.w, seen


def first_weights(v: Vocabulary, hidden: int) -> gru.Weights:
    word_counts = np.zeros((v.head_classes, gru.CLASS_WORDS))
    word_counts.reshape(-1)[: len(v.head)] = v.head_counts
    class_counts = np.concatenate([word_counts.sum(1), v.sums])
    return gru.start(len(v.head) + len(v.endings) + 2, class_counts, word_counts, hidden)


def averaged(docs: DataFrame, w: gru.Weights, v: Vocabulary, rate: float, batch_docs: int = 128, lanes: int = 128, longest: int = 4096,
             most: int = 16) -> gru.Weights:
    """Each task trains a copy of ``w`` on all words of its documents; the mean of the copies, weighted by words, comes back through a tree of sums."""
    sent = docs.sparkSession.sparkContext.broadcast((w, v))  # bounded by the sizes of the model

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held: list = []
        for batch in batches:
            for text in batch.column("text"):
                held.append(text.as_py())
                if len(held) == batch_docs:
                    yield held
                    held = []
        if held:
            yield held

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, words = sent.value
        own, seen = train_whole(start.like(start.flat()), chunks(batches), words, rate, lanes, longest)
        if seen:
            yield pa.RecordBatch.from_pydict({"n": [seen], "w": [own.flat().tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0.0
        for batch in batches:
            for k, flat in zip(batch.column("n").to_pylist(), batch.column("w")):
                n, total = n + k, total + k * np.frombuffer(flat.as_py(), np.float32).astype(np.float64)
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "w": [(total / n).astype(np.float32).tobytes()]})

    copies = materialize(docs.select("text").mapInArrow(local, "n long, w binary"), "copies")
    while (k := copies.count()) > most:
        copies = materialize(copies.repartition(-(-k // most)).mapInArrow(add, "n long, w binary"), "copies")
    rows = copies.collect()  # at most ``most`` models
    if not rows:
        return w
    return w.like(sum(r["n"] * np.frombuffer(r["w"], np.float32).astype(np.float64) for r in rows) / sum(r["n"] for r in rows))


def fit(docs: DataFrame, counted: DataFrame, head_words: int = 1984, endings: int = 63, hidden: int = 24, stretch: int = 64, rounds: int = 2,
        warm_docs: int = 1500) -> tuple[gru.Weights, Vocabulary]:
    """``docs``: doc_id, text, learn. Every training document takes part whole in one of the rounds; ``stretch`` is the warm-up's alone."""
    v = vocabulary(counted, head_words, endings)
    w = first_weights(v, hidden)
    train = docs.where("learn")
    n = train.count()
    warm = train.where(hash_share("doc_id", "text") < min(1.0, warm_docs / max(n, 1))).select("doc_id", "text", F.lit(0).alias("all"))
    rows = thinned(warm, "all", {0: warm_docs}).collect()
    rows = sorted([(r["doc_id"], r["text"] or "") for r in rows], key=lambda r: (r[0] is None, r))
    w, _ = train_on(w, (rows[i: i + 64] for _ in range(3) for i in range(0, len(rows), 64)), v, stretch, 4e-3)
    for k in range(rounds):
        part = train.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == k)
        w = averaged(part, w, v, 2e-3)
    return w, v


_OUT = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64())]
_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, folds: int = 7, held: int = 2, id_column: str = "doc_id", text_column: str = "text", block_chars: int = 12_000_000,
          **parameters) -> DataFrame:
    """Learn from the documents whose fold is not ``held`` and score all of them."""
    frame = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
                        (fold(id_column, folds) != held).alias("learn"))
    chars = frame.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(chars) // block_chars))
    dealt = frame.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long"))
    counted = materialize(block_counts(dealt), "counts")
    w, v = fit(frame, counted, **parameters)
    sent = docs.sparkSession.sparkContext.broadcast((w, v))  # bounded by the sizes of the model

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        weights, words = sent.value
        counts = dict(zip(right.column("word").to_pylist(), right.column("c").to_pylist()))
        number, parts = Words(), []
        for text in left.column("text"):
            parts.append(number.numbers(words_of(text.as_py())))
        distinct = number.take()
        c = np.fromiter((counts[w] for w in distinct), np.float64, len(distinct))
        symbol, cls, word, share = words.symbols(distinct, c)
        base = np.log10((c + 1) / (words.total + words.distinct + 1))
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        ends = np.cumsum(lens)
        inputs = np.empty(len(flat), np.int64)
        inputs[1:] = symbol[flat[:-1]]
        inputs[ends - lens] = len(words.head) + len(words.endings) + 1

        def total(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values[flat], ends - lens)

        found = gru.score_sequences(weights, inputs, cls[flat], word[flat], lens)
        learn = left.column("learn").to_numpy()
        return pa.table([left.column("doc_id"), pa.array(~learn.astype(bool)), pa.array(lens), pa.array(total((c > 0).astype(np.int64))),
                         pa.array(np.full(len(lens), words.total)), pa.array(total(base)), pa.array((found + total(share)) / np.log(10))],
                        schema=pa.schema(_OUT))

    return dealt.groupBy("block").cogroup(counted.select("block", "word", "c").groupBy("block")).applyInArrow(run, _SCHEMA)
