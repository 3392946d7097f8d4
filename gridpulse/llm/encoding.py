"""Exact token ids of whole texts with a public tokenizer, each distinct word encoded once.

Both vocabularies cut a text between a word and the blank before the next one, whatever the words are. So the ids of a text are those of its blank-separated
parts, one after another, and parts recur. A text where that does not hold (white space before a blank, rare white space characters) is
encoded as one piece by the tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

import public_tokenizers
import regex

from gridpulse.llm.common import Grown, Words, hash_words

#: White space on which the tokenizers and str.split() may differ.
_RARE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏    　﻿]")

_PATTERN = regex.compile(public_tokenizers.PATTERN)


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


class Encoder:
    """Ids of texts. ``blanks``: the vocabulary keeps the blank before a word (else it drops white space and case).

    Parts are what stands between blanks, pieces what the tokenizer itself cuts a part into before merging; both are numbered, and numbers stay the same
    until ``limit`` parts are held. ``terms_of`` has a hash of every piece that is not blank. Pieces of letters are encoded many at a time. Without
    ``spans`` the characters of tokens are not kept, and the tokenizer does not look for them.
    """

    def __init__(self, path: str, blanks: bool, limit: int = 400_000, spans: bool = True) -> None:
        self.tokenizer, self.blanks, self.limit, self.spans = load(path), blanks, limit, blanks and spans
        edge = [t[:1] == "\u0120" if blanks else t.endswith("</w>") for t, _ in sorted(
            self.tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda x: x[1])]
        self.edge = np.array(edge)  # tokens that begin (with blanks) or end (without) a word
        self._reset()

    def _reset(self) -> None:
        self.parts, self.pieces = Words(), Words()
        self.ids, self.starts, self.lens = Grown(np.uint32), Grown(np.int64), Grown(np.int64)
        self.piece_ids, self.piece_starts, self.piece_lens = Grown(np.uint32), Grown(np.int64), Grown(np.int64)
        self.piece_begin, self.piece_end, self.piece_chars = Grown(np.int32), Grown(np.int32), Grown(np.int64)
        self.begin, self.end, self.chars = Grown(np.int32), Grown(np.int32), Grown(np.int64)
        self.part_pieces, self.part_starts, self.part_counts = Grown(np.int32), Grown(np.int64), Grown(np.int32)
        self.piece_term = Grown(np.int64)

    def _split(self, text: str) -> list[str] | None:
        if "\0" in text or _RARE.search(text):
            return None
        if not self.blanks:
            return text.split()
        if "  " in text or "\n " in text or "\t " in text or "\r " in text or "\f " in text or "\v " in text:
            return None
        first, *rest = text.split(" ")
        return ["\0" + first, *rest] if first or not rest else rest

    def _cut(self, part: str) -> list[str]:
        """Pieces of a part: a run of letters with at most one mark after it, or what the public pattern finds, or the part as it is."""
        whole = part[:1] == "\0"
        text = part[1:] if whole else " " + part if self.blanks else part
        if self.blanks:
            return _PATTERN.findall(text)
        if whole or "\u03a3" in text:
            return [text]
        if text.isalpha():
            return [text.lower()]
        return [text[:-1].lower(), text[-1]] if text[-1] in ".,;:!?" and text[:-1].isalpha() else [text]

    def parts_of(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's parts, in order."""
        if len(self.parts) > self.limit:
            self._reset()
        out = []
        for text in texts:
            parts = self._split(text) if text else []
            out.append(self.parts.numbers(["\0" + text] if parts is None else parts))
        if fresh := self.parts.take():
            numbers, counts, pieces, blanks = [], [], self.pieces, self.blanks
            for part in fresh:
                if blanks and part.isascii() and part.isalpha():  # one piece, by the public pattern
                    numbers.append(pieces[" " + part])
                    counts.append(1)
                    continue
                cut = self._cut(part)
                numbers += [pieces[p] for p in cut]
                counts.append(len(cut))
            self._encode(self.pieces.take())
            numbers, counts = np.array(numbers, np.int64), np.array(counts, np.int64)
            ends = np.cumsum(counts)
            lens = self.piece_lens.data[numbers]
            sums = np.concatenate([[0], np.cumsum(lens)])
            own = sums[ends] - sums[ends - counts]
            self.starts.extend(self.ids.size + np.cumsum(own) - own)
            self.lens.extend(own)
            self.ids.extend(_gather(self.piece_ids.data, self.piece_starts.data[numbers], lens))
            if self.spans:  # the pieces of a part cover its characters one after another
                chars = self.piece_chars.data[numbers]
                before = np.concatenate([[0], np.cumsum(chars)])
                shift = np.repeat(before[:-1] - np.repeat(before[ends - counts], counts), lens)
                self.begin.extend(_gather(self.piece_begin.data, self.piece_starts.data[numbers], lens) + shift)
                self.end.extend(_gather(self.piece_end.data, self.piece_starts.data[numbers], lens) + shift)
                self.chars.extend(before[ends] - before[ends - counts])
            self.part_starts.extend(self.part_pieces.size + ends - counts)
            self.part_counts.extend(counts)
            self.part_pieces.extend(numbers)
        return out

    def _encode(self, pieces: list[str]) -> None:
        starts, lens = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        plain = [i for i, p in enumerate(pieces) if (p[:1] == " " and p[1:].isalpha() if self.blanks else p.isalpha())]
        left = set(range(len(pieces))) - set(plain)
        groups = [plain[at: at + 200] for at in range(0, len(plain), 200)]
        for some, (ids, offsets) in zip(groups, self._encoded([("" if self.blanks else " ").join([pieces[i] for i in g]) for g in groups])):
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) == len(some):
                begin = edges if self.blanks else np.concatenate([[0], edges[:-1] + 1])
                starts[some] = self.piece_ids.size + begin
                lens[some] = np.diff(np.append(begin, len(ids)))
                if self.spans:
                    offsets = offsets - np.repeat(offsets[begin, 0], lens[some])[:, None]
                self._keep(ids, offsets)
            else:
                left.update(some)
        rest = sorted(left)
        for i, (ids, offsets) in zip(rest, self._encoded([pieces[i] for i in rest])):
            starts[i], lens[i] = self.piece_ids.size, len(ids)
            self._keep(ids, offsets)
        self.piece_chars.extend(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        words = [p.strip().lower() for p in pieces]
        terms = (hash_words(words) >> np.uint64(24)).astype(np.int64)
        terms[np.fromiter(map(len, words), np.int64, len(words)) == 0] = -1
        self.piece_term.extend(terms)
        self.piece_starts.extend(starts)
        self.piece_lens.extend(lens)

    def _encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        for at in range(0, len(texts), 64):
            some = texts[at: at + 64]
            if self.spans:
                for found in self.tokenizer.encode_batch(some, add_special_tokens=False):
                    yield np.array(found.ids, np.uint32), np.array(found.offsets, np.int64).reshape(-1, 2)
            else:
                for found in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                    yield np.array(found.ids, np.uint32), None

    def _keep(self, ids: np.ndarray, offsets: np.ndarray | None) -> None:
        self.piece_ids.extend(ids)
        if self.spans:
            self.piece_begin.extend(offsets[:, 0])
            self.piece_end.extend(offsets[:, 1])

    def ids_of(self, parts: np.ndarray) -> np.ndarray:
        return _gather(self.ids.data, self.starts.data[parts], self.lens.data[parts])

    def terms_of(self, parts: np.ndarray) -> np.ndarray:
        """The hashes of all pieces of a text but blank ones, in order, however the text was split into parts."""
        pieces = _gather(self.part_pieces.data, self.part_starts.data[parts], self.part_counts.data[parts].astype(np.int64))
        terms = self.piece_term.data[pieces]
        return terms[terms >= 0]

    def spans_of(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token in the text; only with ``spans``, of vocabularies that keep blanks."""
        starts, lens, chars = self.starts.data[parts], self.lens.data[parts], self.chars.data[parts]
        shift = np.repeat(np.cumsum(chars) - chars, lens)
        return _gather(self.begin.data, starts, lens) + shift, _gather(self.end.data, starts, lens) + shift


def _gather(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs of ``values`` with those starts and lengths, one after another."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lens), lens) + np.arange(total)]


_HELD: dict[tuple[str, bool, bool], Encoder] = {}


def encoder(path: str, blanks: bool, spans: bool = False) -> Encoder:
    """One encoder for each worker process and vocabulary: later tasks find the words of earlier ones."""
    if (path, blanks, spans) not in _HELD:
        _HELD[path, blanks, spans] = Encoder(path, blanks, spans=spans)
    return _HELD[path, blanks, spans]
