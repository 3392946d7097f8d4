"""Token counts of a document's sections: the whole document is encoded once and its tokens are joined to sections by character spans.

A section is a stretch of characters; sections of a document do not overlap but may leave gaps. A token belongs to the section that holds all of
it. A token across a boundary goes, by ``rule``, to the section with its first character ("first") or to the one that holds most of its
characters, the earlier one of equals ("largest"). Tokens in gaps belong to none. The join is a merge of two sorted lists for each document.

Cases: a null or empty text has one empty section without tokens; tokens of one split character have the same span and stay together; repeated rows
are counted each; a null id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.encoding import encoder

Section = tuple[str, int, int]


def line_kind(line: str) -> str:
    """blank, table (with a cell border), list (item mark first) or prose."""
    bare = line.strip()
    if not bare:
        return "blank"
    if "|" in bare or "\t" in bare:
        return "table"
    return "list" if bare[:2] in ("- ", "* ", "+ ") else "prose"


_LEAD = re.compile(r"[^.!?\n]*[.!?]* ?")


def sections_of_lines(text: str) -> list[Section]:
    """(kind, begin, end): the first sentence with the blank after it, then each run of lines of one kind, line ends included."""
    at = _LEAD.match(text).end()
    out: list[list] = [["lead", 0, at]] if at else []
    while at < len(text):
        end = text.find("\n", at) + 1 or len(text)
        kind = line_kind(text[at:end])
        if out and out[-1][0] == kind:
            out[-1][2] = end
        else:
            out.append([kind, at, end])
        at = end
    return [tuple(s) for s in out] or [("blank", 0, 0)]


def attribute(begins: np.ndarray, ends: np.ndarray, sections: list[Section], rule: str = "largest") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross a boundary. Spans and sections are in ascending order."""
    low = np.array([s[1] for s in sections])
    high = np.array([s[2] for s in sections])
    first, last = np.searchsorted(begins, low), np.searchsorted(begins, high)
    counts, crossing = last - first, np.zeros(len(sections), np.int64)
    # Tokens that begin before an edge and end after it; those are next to the edge.
    met: dict[int, None] = {}
    for edge, at in ((low, first), (high, last)):
        t = at - 1
        for i in np.flatnonzero((t >= 0) & (ends[np.maximum(t, 0)] > edge) if len(ends) else np.zeros(len(edge), bool)):
            met[int(t[i])] = None
    for t in met:
        shares = np.minimum(ends[t], high) - np.maximum(begins[t], low)
        holds = np.flatnonzero((low <= begins[t]) & (begins[t] < high))
        best = int(holds[0]) if rule == "first" and len(holds) else int(np.argmax(shares))
        if len(holds):
            counts[holds[0]] -= 1
        counts[best] += 1
        crossing[best] += 1
    return counts, crossing


_OUT = [("doc_id", pa.int64()), ("section", pa.int32()), ("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()),
        ("n_tokens", pa.int64()), ("n_crossing", pa.int64()), ("doc_tokens", pa.int64())]
_SCHEMA = "doc_id long, section int, kind string, begin long, end long, n_tokens long, n_crossing long, doc_tokens long"


def count(docs: DataFrame, path: str, sections: Callable[[str], list[Section]] = sections_of_lines, rule: str = "largest",
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each section of each document. ``path``: a byte-level vocabulary that keeps white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path, blanks=True, spans=True)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(ids), 256):
                held, columns = texts.slice(at, 256).to_pylist(), [[] for _ in _OUT]
                for doc, text, parts in zip(ids[at: at + 256], held, tokenizer.parts_of(held)):
                    begins, ends = tokenizer.spans_of(parts)
                    found = sections(text or "")
                    n, crossing = attribute(begins, ends, found, rule)
                    k = len(found)
                    for column, values in zip(columns, ([doc] * k, range(k), *zip(*found), n.tolist(), crossing.tolist(), [len(begins)] * k)):
                        column.extend(values)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _OUT)], names=[n for n, _ in _OUT])

    frame = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return frame.mapInArrow(run, _SCHEMA)
