"""Alignment of two tokenizers by pointer jumping: tokens over the same bytes are grouped where both end together.

Tokens of both sides are intervals of the same bytes. Every token points to the farthest-right token that it overlaps, one that ends where it does
pointing to the first side's; successors are doubled (each pointer replaced by the pointer's pointer) for all tokens at once until none moves. Each then
points to the last token of its connected component, which names its group.

Both vocabularies end a token before a blank or line break that stands between other characters, whatever follows, so groups never cross such a place: a
text is cut there, and every distinct part is encoded and aligned once for each worker. A group of n and m tokens has n * m links; equal id pairs of a
group are one entry with its number of links, so nothing grows with the square of a long group but distinct ids.

The documents that hold a pair are counted over the whole table. The pairs' counts go back to the documents by a broadcast while they are few (counted,
``most_rows``); else the pairs in more than a ten-thousandth of all entries, so ten thousand at most, are broadcast, and the others, none of them hot, are
joined by a shuffle.

Cases: a null or empty text has no tokens, and so has one that a tokenizer changes (its joined bytes differ from blank and text): numbers are zero, groups
empty; strings of special tokens are ordinary text; repeated rows count as a document each; a null id is kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import Grown, Words
from gridpulse.llm.encoding import _gather, load
from gridpulse.scratch import materialize

#: A place to cut: before a blank or line break between two characters that are no white space in any reading of it.
_SPACE = "\\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff\u2581"
_CUT = re.compile(f"(?<=[^{_SPACE}])(?=[ \n][^{_SPACE}])")
_CLEAN = re.compile(f"[ \n][^{_SPACE}](?:.*[^{_SPACE}])?", re.DOTALL)
_ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff\u2581]|[ \n][ \n]")


def byte_values() -> dict[str, int]:
    """Characters of a byte-level vocabulary and their bytes: printable ones stand for themselves, the others for code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def split(text: str) -> list[str]:
    """The parts of blank and text."""
    text = " " + text
    if _ODD.search(text) or text[-1] in " \n":
        return _CUT.split(text)
    first, *rest = text.replace("\n", " \n").split(" ")
    return [p if p[:1] == "\n" else " " + p for p in rest]


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For the tokens of both sides, one after the other, the number of the first side's token that ends their group. Both cover the same bytes."""
    over = np.searchsorted(ends_b, ends_a)  # the token with the last byte of each
    under = np.searchsorted(ends_a, ends_b)
    n = len(ends_a)
    if not n:
        return np.empty(0, np.int64)
    points = np.concatenate([np.where(ends_b[over] > ends_a, n + over, np.arange(n)), under])
    while True:
        doubled = points[points]
        if np.array_equal(doubled, points):
            return points
        points = doubled


class Aligner:
    """Parts of texts with their tokens, groups and pairs. A pair of ids is one number, a * (ids of b) + b."""

    def __init__(self, path_a: str, path_b: str, limit: int = 300_000, chars: int = 24_000_000) -> None:
        import sentencepiece

        self.a, self.b = load(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        values = byte_values()
        names = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])
        self.bytes_a = [bytes(values[c] for c in t) if all(c in values for c in t) else t.encode() for t, _ in names]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        if any("\u2581" in self.b.id_to_piece(i).lstrip("\u2581") or "\n" in self.b.id_to_piece(i) for i in range(len(self.bytes_b))):
            raise ValueError("pieces of this vocabulary cross blanks or line breaks")
        self.len_a = np.fromiter(map(len, self.bytes_a), np.int64, len(self.bytes_a))
        self.len_b = np.fromiter(map(len, self.bytes_b), np.int64, len(self.bytes_b))
        wide = max(len(self.bytes_a), len(self.bytes_b))
        self.written = np.array([f"{i}{sign}" for i in range(wide) for sign in ",|;\n"], object)
        self.limit, self.chars = limit, chars
        self._reset()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def _reset(self) -> None:
        self.parts, self.held, self.texts = Words(), 0, []
        self.same, self.numbers = Grown(np.bool_), [Grown(np.int64) for _ in range(4)]  # tokens of a, of b, groups, links
        self.pairs, self.links, self.starts, self.lens = Grown(np.int64), Grown(np.int64), Grown(np.int64), Grown(np.int64)

    def parts_of(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.parts) > self.limit or self.held > self.chars:
            self._reset()
        out = [self.parts.numbers(split(t) if t else []) for t in texts]
        if fresh := self.parts.take():
            self.held += sum(map(len, fresh))
            self._add(fresh)
        return out

    def _encoded(self, parts: list[str]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """An order of the parts, the ids of both sides in it, and how many of them each part has.

        Parts that begin and end cleanly are encoded many at a time and cut by their bytes, the others one by one; a part that a side changes has none.
        """
        order: list[int] = []
        ids: list[list] = [[np.empty(0, np.int64)], [np.empty(0, np.int64)]]
        counts: list[list] = [[np.empty(0, np.int64)], [np.empty(0, np.int64)]]
        clean = [i for i, p in enumerate(parts) if _CLEAN.fullmatch(p)]
        left = sorted(set(range(len(parts))) - set(clean))
        for at in range(0, len(clean), 400):
            some = clean[at: at + 400]
            texts = [parts[i] for i in some]
            sides = self._both("".join(texts))
            if sides is None:
                left += some
                continue
            ends = np.cumsum(np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)))
            for held, n, found, lens in zip(ids, counts, sides, (self.len_a, self.len_b)):
                held.append(found)
                n.append(np.diff(np.searchsorted(np.cumsum(lens[found]), ends), prepend=-1))
            order += some
        for i in left:
            for held, n, found in zip(ids, counts, self._both(parts[i]) or (np.empty(0, np.int64),) * 2):
                held.append(found)
                n.append(np.array([len(found)]))
        return order + left, *[[np.concatenate(ids[k]), np.concatenate(counts[k])] for k in (0, 1)]

    def _both(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; none where a side changes the text."""
        # The second side puts a blank before a text; a line break after that keeps it apart from the text's own first blank.
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode("\n" + text)[2:]
        raw = text.encode()
        if b"".join([self.bytes_a[i] for i in a]) != raw or b"".join([self.bytes_b[i] for i in b]) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def _add(self, fresh: list[str]) -> None:
        order, (a, tokens_a), (b, tokens_b) = self._encoded(fresh)
        place = np.argsort(order)
        last, label = np.unique(terminals(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])), return_inverse=True)
        of_a, of_b = label[: len(a)], label[len(a):]
        sizes_a, sizes_b = np.bincount(of_a, minlength=len(last)), np.bincount(of_b, minlength=len(last))
        part_ends = np.cumsum(tokens_a)
        groups = np.searchsorted(last, part_ends) - np.searchsorted(last, part_ends - tokens_a)
        part_of = np.repeat(np.arange(len(fresh)), groups)
        links = np.bincount(part_of, sizes_a * sizes_b, len(fresh)).astype(np.int64)
        for held, values in zip(self.numbers, (tokens_a, tokens_b, groups, links)):
            held.extend(values[place])
        self.same.extend((tokens_a > 0)[place])
        texts = self._texts(a, b, of_a, of_b, part_of, groups)
        self.texts += [texts[i] for i in place.tolist()]
        starts, lens = self._pairs(a, b, sizes_a, sizes_b, part_of, len(fresh))
        self.starts.extend(starts[place])
        self.lens.extend(lens[place])

    def _texts(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, part_of: np.ndarray, groups: np.ndarray) -> list[str]:
        """The groups of each part as text: every id is followed by the sign that separates it from the next."""
        side, group = np.repeat([0, 1], [len(a), len(b)]), np.concatenate([of_a, of_b])
        by = np.lexsort([side, group])  # stable: tokens stay in their order
        side, group, ids = side[by], group[by], np.concatenate([a, b])[by]
        new_side, new_group = np.r_[side[1:] != side[:-1], True], np.r_[group[1:] != group[:-1], True]
        new_part = np.r_[part_of[group[1:]] != part_of[group[:-1]], True]
        sign = np.where(new_part, 3, np.where(new_group, 2, np.where(new_side, 1, 0)))
        whole = "".join(self.written[ids * 4 + sign].tolist()) if len(ids) else ""
        found = iter(whole.split("\n"))
        return [next(found) if n else "" for n in groups.tolist()]

    def _pairs(self, a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, part_of: np.ndarray,
               n_parts: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of each part and their links."""
        wide = len(self.bytes_b)
        first_a, first_b = np.cumsum(sizes_a) - sizes_a, np.cumsum(sizes_b) - sizes_b
        small = np.flatnonzero(sizes_a * sizes_b <= 64)
        reps = (sizes_a * sizes_b)[small]
        group = np.repeat(small, reps)
        within = np.arange(len(group)) - np.repeat(np.cumsum(reps) - reps, reps)
        codes = [a[first_a[group] + within // sizes_b[group]] * wide + b[first_b[group] + within % sizes_b[group]]]
        parts, counts = [part_of[group]], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(sizes_a * sizes_b > 64):  # long groups: each side's distinct ids with their numbers first
            ids_a, n_a = np.unique(a[first_a[g]: first_a[g] + sizes_a[g]], return_counts=True)
            ids_b, n_b = np.unique(b[first_b[g]: first_b[g] + sizes_b[g]], return_counts=True)
            codes.append((ids_a[:, None] * wide + ids_b).ravel())
            counts.append((n_a[:, None] * n_b).ravel())
            parts.append(np.full(len(codes[-1]), part_of[g]))
        code, part, count = np.concatenate(codes), np.concatenate(parts), np.concatenate(counts)
        order = np.lexsort([code, part])
        code, part, count = code[order], part[order], count[order]
        new = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (part[1:] != part[:-1])]) if len(code) else np.empty(0, np.int64)
        lens = np.bincount(part[new], minlength=n_parts)
        starts = self.pairs.size + np.cumsum(lens) - lens
        self.pairs.extend(code[new])
        self.links.extend(np.add.reduceat(count, new) if len(new) else count)
        return starts, lens


_HELD: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process: later tasks find the parts of earlier ones."""
    if (path_a, path_b) not in _HELD:
        _HELD[path_a, path_b] = Aligner(path_a, path_b)
    return _HELD[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``), pairs (distinct, ascending) and each one's links."""
    kinds = [pa.int64()] * 5 + [pa.string()]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        wide = len(both.bytes_a) * len(both.bytes_b)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = both.parts_of(some.column("text").to_pylist())
                found = [p if both.same.data[p].all() else p[:0] for p in found]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                parts = np.concatenate(found)
                of = np.repeat(np.arange(len(found)), sizes)
                sums = [np.bincount(of, held.data[parts], len(found)).astype(np.int64) for held in both.numbers]
                lens = both.lens.data[parts]
                keys, where = np.unique(np.repeat(of, lens) * wide + _gather(both.pairs.data, both.starts.data[parts], lens), return_inverse=True)
                links = np.bincount(where, _gather(both.links.data, both.starts.data[parts], lens), len(keys)).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(np.bincount(keys // wide, minlength=len(found)))]).astype(np.int32)
                groups = [";".join([both.texts[i] for i in p.tolist()]) for p in found]
                arrays = [some.column("doc_id"), *sums, groups]
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v, pa.int64())) for v in (keys % wide, links)]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) if not isinstance(v, pa.Array) else v for v, t in zip(arrays, kinds)] + lists, names=names)

    frame = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    return frame.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, links array<long>")


def pair_counts(aligned: DataFrame, ids_of_b: int) -> DataFrame:
    """pair, count: how many documents hold it; best: none of its first id's pairs is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    counts = materialize(counts.withColumn("a", F.call_function("div", F.col("pair"), F.lit(ids_of_b))), "pairs")
    highest = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def linked(aligned: DataFrame, ids_of_b: int, most_rows: int = 500_000, share: int = 10_000) -> DataFrame:
    """``aligned`` without pairs and groups, with n_best and count_sum. ``aligned`` is read several times: hand in a written table with a number ``row``."""
    counts = materialize(pair_counts(aligned, ids_of_b), "pair-counts")
    n, entries = counts.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    found = aligned.select("row", F.inline(F.arrays_zip("pairs", "links"))).withColumnRenamed("pairs", "pair")
    if n <= most_rows:
        met = found.join(F.broadcast(counts), "pair")
    else:
        often = counts["count"] > entries / share
        hot = F.broadcast(counts.where(often))  # fewer than ``share`` rows
        met = found.join(hot, "pair").unionByName(found.join(hot, "pair", "left_anti").join(counts.where(~often).hint("merge"), "pair"))
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                                  F.sum(F.col("links") * F.col("count")).alias("count_sum"))
    kept = [c for c in aligned.columns if c not in ("row", "pairs", "links", "groups")]
    none = F.lit(0).cast("long")
    return aligned.drop("pairs", "links", "groups").join(sums, "row", "left").select(
        *kept, F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"))


def digests(docs: DataFrame, path_a: str, path_b: str, **options) -> DataFrame:
    """One row for each document: numbers of tokens, groups and links, those of the best pairs, the sum of their counts, the digest of the groups."""
    import sentencepiece

    found = align(docs, path_a, path_b)
    sha = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    stored = materialize(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links", sha,
                                      "pairs", "links"), "aligned")
    wide = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    return linked(stored, wide, **options).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
