"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ by ``rate`` * m edits (insertions, deletions, replacements). Cut into one piece more than that budget, at
least one piece of any such occurrence is left whole; an Aho-Corasick automaton finds all pieces in one pass over a document, and each
place is verified with Myers' bit-parallel edit distance. Both sides are compared lower-cased, with each run of other than word characters as one
blank.

Items are read in slices of bounded size, and each slice meets all documents; one pass is enough for benchmarks of ordinary size.

Cases: null or empty texts and items match nothing; an item shorter than ``least`` characters has no error budget and matches as whole words
only; repeated rows and items are reported each; of several occurrences the one with the fewest edits counts, then the first; rows with a null
id are reported with it; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import WORD

SCHEMA = "doc_id long, item_id long, edits int, budget int, start int, end int, passage string"


def normal(text: str) -> str:
    return " ".join(WORD.findall(text.lower()))


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` stretches of about equal length with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def peq(pattern: str) -> dict[str, int]:
    bits: dict[str, int] = {}
    for i, c in enumerate(pattern):
        bits[c] = bits.get(c, 0) | 1 << i
    return bits


def myers(bits: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Fewest edits between the pattern and a substring of ``text``, and where the first such substring ends."""
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = mask, 0, m, m, 0
    for i, c in enumerate(text, 1):
        eq = bits.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score < best:
            best, end = score, i
        ph = ph << 1 & mask
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
    return best, end


class Matcher:
    """All items of one slice, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], rate: float, least: int) -> None:
        self.items, found = [], {}
        for item_id, text in items:
            pattern = normal(text)
            if not pattern:
                continue
            short = len(pattern) < least
            pattern = f" {pattern} " if short else pattern
            budget = 0 if short else int(len(pattern) * rate)
            at = len(self.items)
            self.items.append((item_id, pattern, budget, peq(pattern), peq(pattern[::-1])))
            for offset, piece in pieces(pattern, budget):
                found.setdefault(piece, []).append((at, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int, int, str]]:
        """(item id, edits, budget, start, end, passage) of the best occurrence of each item."""
        if not self.items:
            return []
        text = f" {normal(text)} "
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for at, offset in where:
                _, pattern, budget, _, _ = self.items[at]
                start = last + 1 - size - offset - budget
                stop = start + len(pattern) + 2 * budget
                own = windows.setdefault(at, [])
                if own and start <= own[-1][1] and start >= own[-1][0] - budget:
                    own[-1] = [min(own[-1][0], start), max(own[-1][1], stop)]
                else:
                    own.append([start, stop])
        out = []
        for at, spans in windows.items():
            item_id, pattern, budget, bits, back = self.items[at]
            best = None
            for start, stop in sorted(spans):
                low = max(0, start)
                edits, end = myers(bits, len(pattern), text[low: stop])
                if edits <= budget and (best is None or edits < best[0]):
                    _, length = myers(back, len(pattern), text[low: low + end][::-1])
                    best = (edits, low + end - length, low + end)
            if best:
                out.append((item_id, best[0], budget, best[1], best[2], text[best[1]: best[2]].strip()))
        return out


def _slices(items: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    """The items, some ``most`` characters at a time."""
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row["item"], row["text"]))
        size += len(row["text"])
        if size >= most:
            yield held
            held, size = [], 0
    yield held


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
            item_text: str = "text", rate: float = 0.05, least: int = 24, slice_chars: int = 4_000_000) -> DataFrame:
    """One row for each document and item that occurs in it within the error budget; positions count in the normalised text."""
    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).alias("text")).where("text is not null")
    wanted = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).where("text is not null")
    out = None
    for held in _slices(wanted, slice_chars):
        part = _pass(frame, held, rate, least)
        out = part if out is None else out.unionByName(part)
    return out


def _pass(frame: DataFrame, held: list[tuple[int, str]], rate: float, least: int) -> DataFrame:
    sent = frame.sparkSession.sparkContext.broadcast(held)  # at most one slice

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, rate, least)
        for batch in batches:
            rows = [(doc, *hit) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"))
                    for hit in matcher.find(text.as_py())]
            if rows:
                names = SCHEMA.replace(",", "").split()[::2]
                kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return frame.mapInArrow(run, SCHEMA)
