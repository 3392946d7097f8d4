"""Packing by lexical retrieval: each window is filled with the unused documents that a BM25 index ranks nearest to its seed.

Documents are dealt over shards by a hash of their id; every shard has an inverted index of its own, of at most ``shard_docs`` documents or
``shard_chars`` characters, and answers the queries of its own seeds, each with all terms of the seed. Of a document, stretches of a whole window become sequences by
themselves; what is left over is packed. A seed's window takes its neighbours in the order of their scores, the last one cut to fit, and after the
neighbours the shard's next unused documents, so every window of a shard but the last is full. The last is stored in stretches of powers of two, so
nothing is padded.

The terms of a document are all pieces that the tokenizer cuts its text into before merging (words, numbers, marks), without white space and case.

Cases: null and empty texts are their end id alone; texts longer than any window are cut, each id lies in exactly one piece; equal scores go to the
document that comes first by id; repeated rows are packed each; a null id is kept; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from gridpulse.llm.encoding import encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, seed_id long"
_TYPES = [pa.int64()] * 8
_NAMES = SCHEMA.replace(",", "").split()[::2]


class Index:
    """BM25 over documents given as arrays of term numbers."""

    def __init__(self, docs: list[np.ndarray], k1: float = 1.2, b: float = 0.75) -> None:
        self.n = len(docs)
        lens = np.array([len(d) for d in docs], np.float64)
        of = np.repeat(np.arange(self.n), lens.astype(np.int64))
        terms = np.concatenate([*docs, np.empty(0, np.int64)]).astype(np.int64)
        keys, tf = np.unique(terms * max(1, self.n) + of, return_counts=True)
        term, self.doc = keys // max(1, self.n), keys % max(1, self.n)
        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.empty(0, np.int64)
        self.starts, self.df = starts, np.diff(np.append(starts, len(term)))
        self.held = self.df  # postings that are still there
        idf = np.log(1 + (self.n - self.df + 0.5) / (self.df + 0.5))
        norm = k1 * (1 - b + b * lens / max(lens.mean(), 1.0)) if self.n else lens
        self.weight = np.repeat(idf, self.df) * tf * (k1 + 1) / (tf + norm[self.doc])
        slot = np.repeat(np.arange(len(starts)), self.df)
        order = np.argsort(self.doc, kind="stable")
        self.of_doc, self.ends = slot[order], np.cumsum(np.bincount(self.doc, minlength=self.n))

    def drop(self, unused: np.ndarray) -> None:
        """Let go of the postings of used documents; frequencies, and with them all scores, stay what they were."""
        keep = unused[self.doc]
        slot = np.repeat(np.arange(len(self.starts)), self.held)[keep]
        self.doc, self.weight = self.doc[keep], self.weight[keep]
        self.held = np.bincount(slot, minlength=len(self.starts))
        self.starts = np.cumsum(self.held) - self.held

    def neighbours(self, doc: int, unused: np.ndarray, query_terms: int | None = None, most: int | None = None) -> np.ndarray:
        """Unused documents that share one of the document's terms (of its rarest ``query_terms`` shared ones, if given), best first; the
        ``most`` best and what equals the last of them, if given."""
        own = self.of_doc[self.ends[doc - 1] if doc else 0: self.ends[doc]]
        own = own[self.df[own] > 1]
        if query_terms is not None and len(own) > query_terms:
            own = own[np.argsort(self.df[own], kind="stable")[:query_terms]]
        if not len(own):
            return own
        begin, n = self.starts[own], self.held[own]
        ends = np.cumsum(n)
        at = np.repeat(begin - (ends - n), n) + np.arange(ends[-1])
        scores = np.bincount(self.doc[at], self.weight[at], self.n)
        scores[~unused] = 0
        found = np.flatnonzero(scores)
        if most is not None and len(found) > most:
            found = found[scores[found] >= -np.partition(-scores[found], most - 1)[most - 1]]
        return found[np.argsort(-scores[found], kind="stable")]


def fill(left: np.ndarray, index: Index, window: int, query_terms: int | None = None) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Windows as (seed, [(document, ids taken)]). ``left``: how many ids each document has to pack; changed in place."""
    unused, next_free = left > 0, 0
    in_index = int(unused.sum())
    for seed in range(len(left)):
        while unused[seed]:
            taken, space = [], window

            def take(doc: int) -> None:
                nonlocal space
                n = min(int(left[doc]), space)
                taken.append((doc, n))
                left[doc] -= n
                space -= n
                unused[doc] = left[doc] > 0

            take(seed)
            while space:
                found = index.neighbours(seed, unused, query_terms, 64)
                if not len(found):
                    break
                for doc in found:
                    take(int(doc))
                    if not space:
                        break
            if (n := int(unused.sum())) < 0.85 * in_index:
                index.drop(unused)
                in_index = n
            while space and next_free < len(left):
                if unused[next_free]:
                    take(next_free)
                if not unused[next_free]:
                    next_free += 1
            yield seed, taken


class _Shard:
    """The documents of one index: ids, token arrays and term arrays; gives the pieces of all their sequences."""

    def __init__(self) -> None:
        self.ids, self.tokens, self.terms, self.chars = [], [], [], 0

    def pieces(self, sequence: int, window: int, query_terms: int | None) -> tuple[list[tuple], int]:
        out, done = [], np.zeros(len(self.ids), np.int64)

        def put(doc: int, length: int, offset: int, seed: int) -> None:
            start, tokens = int(done[doc]), self.tokens[doc]
            crc = zlib.crc32(tokens[start: start + length].astype("<u4").tobytes())
            out.append((self.ids[doc], start, length, crc, len(tokens), sequence, offset, self.ids[seed]))
            done[doc] += length

        for doc, tokens in enumerate(self.tokens):
            for _ in range(len(tokens) // window):
                put(doc, window, 0, doc)
                sequence += 1
        left = np.array([len(t) for t in self.tokens], np.int64) - done
        for seed, taken in fill(left, Index(self.terms), window, query_terms):
            total = sum(n for _, n in taken)
            room = 1 << (total.bit_length() - 1) if total < window else window
            offset = 0
            for doc, n in taken:
                while n:
                    part = min(n, room - offset)
                    put(doc, part, offset, seed)
                    n -= part
                    total -= part
                    offset += part
                    if offset == room:
                        sequence, offset = sequence + 1, 0
                        room = 1 << (total.bit_length() - 1) if total else window
        return out, sequence


def pack(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", window: int = 1024, end_id: int = 0,
         query_terms: int | None = None, shard_docs: int = 4096, shard_chars: int = 16_000_000) -> DataFrame:
    """One row for each piece: document, start in the document, length, crc32 of its ids, document's ids, sequence, offset, seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, shard = encoder(path, blanks=True), _Shard()
        sequence = TaskContext.get().partitionId() << 40

        def finish() -> Iterator[pa.RecordBatch]:
            nonlocal shard, sequence
            rows, sequence = shard.pieces(sequence, window, query_terms)
            shard = _Shard()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(ids), 256):
                held = texts.slice(at, 256).to_pylist()
                found = tokenizer.parts_of(held)
                for doc, text, parts in zip(ids[at: at + 256], held, found):
                    shard.ids.append(doc)
                    shard.tokens.append(np.append(tokenizer.ids_of(parts), np.uint32(end_id)))
                    shard.terms.append(tokenizer.terms_of(parts))
                    shard.chars += len(text or "")
                if len(shard.ids) >= shard_docs or shard.chars >= shard_chars:
                    yield from finish()
        yield from finish()

    frame = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    # Ids alone decide the shard and the order within: the result does not hang on how the input is split.
    return frame.repartition(F.xxhash64("doc_id")).sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)
