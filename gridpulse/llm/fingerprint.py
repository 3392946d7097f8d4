"""Document fingerprints: threshold-scaled sketches of five-word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, and the smallest hash in any case, so that a short text has one too. Sketches
of parts merge by union, and two of them estimate how much of the smaller text the larger one holds, whatever their lengths.

``neighbours`` walks the documents in descending order of their ids and compares each with its own edited text and with the document after it.
Ranges of ids are sorted each by itself; the first document of a range is also sent to the range before it, whose last document it follows.

Cases: a null or empty text and one without a word has an empty fingerprint, which is like another empty one (1) and unlike any other (0); a text of fewer than five words is
one shingle; rows that share an id are ordered by their text, descending; a null id comes last; repeated rows are compared like any
others; a single document is its own next one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import WORD, WordHashes, shingles


def sketch(text: str, hashes: WordHashes, fraction: float = 1 / 4, k: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes: all of the text's shingles below ``fraction`` of the range, and the smallest."""
    found = shingles(hashes.of(WORD.findall(text.lower())), k)
    if not len(found):
        return found
    kept = found[found < np.uint64(int(fraction * 2 ** 64))]
    return np.unique(np.append(kept, found.min()))


def merge(a: np.ndarray, b: np.ndarray, fraction: float = 1 / 4) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    both = np.union1d(a, b)
    kept = both[both < np.uint64(int(fraction * 2 ** 64))]
    return np.unique(np.append(kept, both[:1]))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of the smaller text's shingles that the other text has."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def text_form(found: np.ndarray) -> str:
    """Twelve hexadecimal digits for each hash, in ascending order."""
    return (found >> np.uint64(16)).astype(">u8").tobytes().hex() if not len(found) else "".join(
        f"{v:012x}" for v in (found >> np.uint64(16)).tolist())


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the text that follows."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n] if n else text


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [n for n, _ in _OUT]


def _row(doc: int | None, text: str, own: np.ndarray, following: str, after: np.ndarray, hashes: WordHashes, fraction: float, k: int) -> tuple:
    other = edited(text, following)
    changed = own if other == text else sketch(other, hashes, fraction, k)
    return (doc, len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), text_form(own), text_form(changed),
            containment(own, changed), containment(own, after))


def neighbours(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fraction: float = 1 / 4, k: int = 5) -> DataFrame:
    """One row for each document: its length, edited text's digest, both fingerprints, likeness to the edited text and to the next document."""
    frame = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ranges = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [1 - i / ranges for i in range(ranges)]
    found = frame.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0]  # ids that occur: a first one for each range
    firsts = np.array(sorted(set(found or []) | ({frame.agg(F.max("doc_id")).first()[0]} if found else set())), np.int64)
    sent = docs.sparkSession.sparkContext.broadcast(firsts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ranges are numbered upwards from the lowest ids. The first document of a range also follows the last of the range above it."""
        top = max(0, len(sent.value) - 1)
        for batch in batches:
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            own = np.where(known, np.searchsorted(sent.value, values), 0)
            edge = known & np.isin(values, sent.value)
            above = np.where(own == top, 0, own + 1)  # after the last document comes the first
            rows = np.concatenate([np.arange(len(own)), np.flatnonzero(edge)])
            follows = np.zeros(len(rows), bool)
            follows[len(own):] = True
            taken = pa.Table.from_batches([batch]).take(pa.array(rows))
            taken = taken.append_column("range", pa.array(np.concatenate([own, above[edge]]), pa.int64()))
            yield from taken.append_column("follows", pa.array(follows)).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, first, rows = WordHashes(), None, None, []

        def last() -> None:
            """Only where no row has an id does nothing follow the last one: then the first does."""
            if held is not None:
                rows.append(_row(*held[:3], *first, hashes, fraction, k))

        for batch in batches:
            for doc, text, at, follows in zip(*[batch.column(c) for c in ("doc_id", "text", "range", "follows")]):
                doc, text, at, follows = doc.as_py(), text.as_py(), at.as_py(), follows.as_py()
                if follows and (held is None or held[3] != at):
                    continue  # a further row with the id of the one that followed
                own = sketch(text, hashes, fraction, k)
                if held is not None and held[3] == at:
                    rows.append(_row(*held[:3], text, own, hashes, fraction, k))
                else:
                    last()
                    first = (text, own)
                held = None if follows else (doc, text, own, at)
                if len(rows) >= 500:
                    yield _batch(rows)
                    rows = []
        last()
        if rows:
            yield _batch(rows)

    placed = frame.mapInArrow(place, "doc_id long, text string, range long, follows boolean")
    ordered = placed.repartition("range").sortWithinPartitions("range", "follows", F.desc_nulls_last("doc_id"), F.desc("text"))
    return ordered.mapInArrow(run, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _OUT)], names=_NAMES)
