"""Token ids in compressed blocks: an adaptive context-mixing model drives a range coder.

Each block is coded on its own: the model starts empty and a checksum of the ids follows. Inside a block the ids are cut into ``LANES`` equal
stretches that are coded in step with one shared model, so that numpy advances many stretches of many blocks at once.

The chance of an id is a mixture of three predictions: the id that last followed the two before it (order 2), the one that last followed the
one before (order 1), and the frequency of every id in the block so far (order 0). The mixture's weights are learned on the way, one pair for
each combination of the confidences that the order-2 and order-1 contexts have earned. Order-0 frequencies are brought up to date at growing
intervals. All arithmetic is in integers: another machine decodes the same ids.

Block layout, little-endian: magic ``GPID``, version u8, 3 bytes zero, vocabulary u32, number of ids u32, crc32 of the ids as u32 each u32, then for
each lane the number of 32-bit words u32, then the lanes' words one after another.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION, LANES = b"GPID", 1, 64
HEADER = struct.Struct("<4sB3xIII")
_I = np.int64
_TOTAL = 24  # bits of the coder's resolution
_ORDER0 = 20  # bits of the order-0 frequencies
_COARSE = 8  # bits of them that the decoder's first table leaves open
_HASH = 16  # bits of the order-2 table
# change of an entry by its confidence, after a miss and after a hit
_CHANGE = np.array([c for s in range(8) for c in (-((s + 1) >> 1), int(s < 7))], np.int32)
_EMPTY = np.int32(-8)  # guess -1, confidence 0
_RENORM, _WORD = np.uint64(1 << 30), np.uint64(32)
_REST = np.uint64((1 << 30) - 1)
_LOW_MASK = np.uint64((1 << 62) - 1)


class _Model:
    """The models of several blocks; the arrays have an entry for each lane that still has ids."""

    def __init__(self, blocks: int, vocabulary: int) -> None:
        self.blocks, self.vocabulary = blocks, vocabulary
        self.block = np.repeat(np.arange(blocks), LANES)
        # an entry is the guessed id times 8, plus the confidence 0 to 7
        self.order1 = np.full(blocks * vocabulary, _EMPTY)
        self.order2 = np.full(blocks << _HASH, _EMPTY)
        # weights of order 2 and order 1 (16 bits) by both confidences
        self.weight2, self.weight1 = np.full(blocks * 64, 1 << 12, np.int32), np.full(blocks * 64, 1 << 12, np.int32)
        self.counts, self.came = np.zeros((blocks, vocabulary), np.int32), np.zeros((blocks, vocabulary), np.int32)  # until and since the last rebuild
        self.cum = np.zeros(blocks * (vocabulary + 1), np.int32)
        self.coarse = np.zeros(blocks * ((1 << (_ORDER0 - _COARSE)) + 1), _I)
        self.fresh, self.since = np.ones(blocks, _I), np.full(blocks, 2, _I)  # ids since the last rebuild that had no count then, and all of them
        self.prev1, self.prev2 = np.zeros(blocks * LANES, _I), np.zeros(blocks * LANES, _I)
        self.steps, self.rebuild_at = 0, 16
        self.seen: list[np.ndarray] = []
        self._bases()
        self.rebuild()

    def _bases(self) -> None:
        self.base1, self.base2 = self.block * self.vocabulary, self.block << _HASH
        self.base_weight, self.base_cum = self.block * 64, self.block * (self.vocabulary + 1)
        self.base_coarse = self.block * ((1 << (_ORDER0 - _COARSE)) + 1)

    def keep(self, lanes: np.ndarray) -> None:
        """Go on with these of the lanes only."""
        self._count()
        self.block, self.prev1, self.prev2 = self.block[lanes], self.prev1[lanes], self.prev2[lanes]
        self._bases()

    def _count(self) -> None:
        if self.seen:
            np.add.at(self.came.reshape(-1), np.concatenate(self.seen), 1)
            self.seen = []

    def rebuild(self) -> None:
        """Cumulative order-0 frequencies with at least one for each id.

        Ids without a count share what such ids took of the ids since the rebuild before, so repeated ids are cheap early and spread ones stay so.
        """
        self._count()
        room, one = (1 << _ORDER0) - self.vocabulary, np.arange(1, self.vocabulary + 1, dtype=_I)
        marks = np.arange(0, (1 << _ORDER0) + 1, 1 << _COARSE)
        cum, coarse = self.cum.reshape(self.blocks, -1), self.coarse.reshape(self.blocks, -1)
        for i, (counts, came) in enumerate(zip(self.counts, self.came)):
            n = int(came.sum(dtype=_I))
            if n:
                self.since[i], self.fresh[i] = n + 2, n + 1 - int(came[counts > 0].sum(dtype=_I))
                counts += came
                came[:] = 0
            sums, rest = np.cumsum(counts, dtype=_I), np.cumsum(counts == 0, dtype=_I)
            total, left = int(sums[-1]), int(rest[-1])
            share = room if not total else room * int(self.fresh[i]) // int(self.since[i]) if left else 0
            cum[i, 1:] = sums * (room - share) // max(total, 1) + rest * share // max(left, 1) + one
            coarse[i] = np.searchsorted(cum[i], marks, "right") - 1
            coarse[i, -1] = self.vocabulary - 1

    def predict(self) -> None:
        """Guesses of both orders and the shares a and b of the coder's range that the mixture gives them."""
        self.at1 = self.base1 + self.prev1
        key = (self.prev2 * 0x9E3779B1 + self.prev1 * 0x85EBCA77) & 0xFFFFFFFF
        key >>= 32 - _HASH
        self.at2 = key + self.base2
        self.entry2, self.entry1 = self.order2.take(self.at2), self.order1.take(self.at1)
        self.guess2, self.guess1 = self.entry2 >> 3, self.entry1 >> 3
        self.cell = self.base_weight + (((self.entry2 & 7) << 3) | (self.entry1 & 7))
        self.w2, self.w1 = self.weight2.take(self.cell), self.weight1.take(self.cell)
        # An empty context has no share: its guess is -1.
        self.a = ((self.w2 * (self.guess2 >= 0)).astype(_I) * 15) << (_TOTAL - 20)
        self.b = ((((15 << (_TOTAL - 4)) - self.a) >> 16) * self.w1) * (self.guess1 >= 0)
        self.ab = self.a + self.b
        self.free = (1 << _TOTAL) - self.ab

    def spread(self, cum: np.ndarray) -> np.ndarray:
        """The place of an order-0 cumulative frequency in the coder's range."""
        return self.ab + ((self.free * cum) >> _ORDER0)

    def update(self, ids: np.ndarray) -> None:
        hit2, hit1 = ids == self.guess2, ids == self.guess1
        # 31/32 of the old weight; a context without a guess keeps its weight
        self.weight2[self.cell] = self.w2 + (((hit2 * np.int32(64000)) - self.w2) >> 5) * (self.guess2 >= 0)
        self.weight1[self.cell] = self.w1 + (((hit1 * np.int32(64000)) - self.w1) >> 5) * (~hit2 & (self.guess1 >= 0))
        fresh = (ids << 3).astype(np.int32)
        for table, at, entry, hit in ((self.order2, self.at2, self.entry2, hit2), (self.order1, self.at1, self.entry1, hit1)):
            # a hit adds one to the confidence, a miss halves it; a guess without confidence is replaced
            table[at] = np.where(hit | ((entry & 6) > 0), entry + _CHANGE.take(((entry & 7) << 1) + hit), fresh)
        self.prev2, self.prev1 = self.prev1, ids
        self.seen.append(self.base1 + ids)
        self.steps += 1
        if len(self.seen) == 128:
            self._count()
        if self.steps == self.rebuild_at:
            self.rebuild()
            self.rebuild_at += min(2 * self.steps, 4096)


def _lanes(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Start of every lane among the ids of all blocks, and its length."""
    edges = np.array([[n * i // LANES for i in range(LANES + 1)] for n in sizes], _I)
    first = (np.cumsum(sizes) - sizes)[:, None]
    return (edges[:, :-1] + first).reshape(-1), np.diff(edges, axis=1).reshape(-1)


def _phases(lens: np.ndarray):
    """(first step, end step, lanes that still have ids) while that set stays the same."""
    begin = 0
    for end in np.unique(lens[lens > 0]).tolist():
        yield begin, end, np.flatnonzero(lens >= end)
        begin = end


def encode(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """Each array of ids as one coded block."""
    if not blocks:
        return []
    starts, lens = _lanes([len(b) for b in blocks])
    flat = np.concatenate(blocks).astype(_I)
    model = _Model(len(blocks), vocabulary)
    n = len(starts)
    low, size = np.zeros(n, np.uint64), np.full(n, 1 << 62, np.uint64)
    words, filled = np.zeros((n, 256), np.uint64), np.zeros(n, _I)
    live = np.arange(n)

    def emit(lanes: np.ndarray) -> None:
        nonlocal words
        top = filled[lanes]
        if top.max() + 1 >= words.shape[1]:
            words = np.concatenate([words, np.zeros_like(words)], axis=1)
        words[lanes, top] = low[lanes] >> np.uint64(30)
        filled[lanes] = top + 1
        low[lanes] = (low[lanes] & _REST) << _WORD

    for begin, end, lanes in _phases(lens):
        model.keep(np.flatnonzero(np.isin(live, lanes, assume_unique=True)))
        live, at = lanes, starts[lanes]
        for step in range(begin, end):
            ids = flat.take(at + step)
            model.predict()
            where = model.base_cum + ids
            first, last = model.spread(model.cum.take(where)), model.spread(model.cum.take(where + 1))
            one, two = ids == model.guess1, ids == model.guess2
            one &= model.b > 0
            two &= model.a > 0
            first = np.where(two, 0, np.where(one, model.a, first)).astype(np.uint64)
            last = np.where(two, model.a, np.where(one, model.ab, last)).astype(np.uint64)
            own = size[live]
            unit = own >> np.uint64(_TOTAL)
            moved = low[live] + unit * first
            own = unit * (last - first)
            over = moved > _LOW_MASK
            if over.any():  # a carry into the word before
                r = live[over]
                words[r, filled[r] - 1] += np.uint64(1)
                moved &= _LOW_MASK
            low[live] = moved
            short = own < _RENORM
            if short.any():
                emit(live[short])
                own[short] <<= _WORD
            size[live] = own
            model.update(ids)
    for _ in range(2):  # the rest of low
        emit(np.arange(n))
    out = []
    for i, ids in enumerate(blocks):
        head = HEADER.pack(MAGIC, VERSION, vocabulary, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
        own = range(i * LANES, (i + 1) * LANES)
        out.append(head + filled[own].astype("<u4").tobytes() + b"".join(_carried(words[r, : filled[r]]) for r in own))
    return out


def _carried(words: np.ndarray) -> bytes:
    """Words of 32 bits, carries moved to the words before."""
    while (words >> _WORD).any():
        carry = words >> _WORD
        words &= np.uint64(0xFFFFFFFF)
        words[:-1] += carry[1:]
    return words.astype("<u4").tobytes()


def decode(payloads: list[bytes]) -> list[np.ndarray]:
    """The ids of coded blocks of one vocabulary; a block that fails its checksum raises ValueError."""
    if not payloads:
        return []
    heads = [HEADER.unpack_from(p) for p in payloads]
    if any(h[:2] != (MAGIC, VERSION) for h in heads):
        raise ValueError("not a block of token ids")
    vocabulary, sizes = heads[0][2], [h[3] for h in heads]
    counts = np.concatenate([np.frombuffer(p, "<u4", LANES, HEADER.size) for p in payloads]).astype(_I)
    data = np.concatenate([*[np.frombuffer(p, "<u4", offset=HEADER.size + 4 * LANES) for p in payloads], np.zeros(4, "<u4")]).astype(np.uint64)
    next_word = np.cumsum(counts) - counts
    starts, lens = _lanes(sizes)
    out = np.zeros(sum(sizes), _I)
    model = _Model(len(payloads), vocabulary)
    # 62 bits of the stream, and the two bits of the last word that do not fit yet
    code = (data[next_word] << np.uint64(30)) | (data[next_word + 1] >> np.uint64(2))
    spare = data[next_word + 1] & np.uint64(3)
    next_word += 2
    size = np.full(len(starts), 1 << 62, np.uint64)
    live = np.arange(len(starts))
    for begin, end, lanes in _phases(lens):
        kept = np.flatnonzero(np.isin(live, lanes, assume_unique=True))
        model.keep(kept)
        live, code, spare, next_word, size = lanes, code[kept], spare[kept], next_word[kept], size[kept]
        at = starts[live]
        for step in range(begin, end):
            model.predict()
            unit = size >> np.uint64(_TOTAL)
            value = np.minimum(code // unit, np.uint64((1 << _TOTAL) - 1)).astype(_I)
            two = value < model.a
            one = value < model.ab
            # The order-0 id: the last whose place is not above the value.
            target = (((np.maximum(value - model.ab, 0) + 1) << _ORDER0) - 1) // model.free
            np.minimum(target, (1 << _ORDER0) - 1, out=target)
            mark = model.base_coarse + (target >> _COARSE)
            found, high = model.coarse.take(mark), model.coarse.take(mark + 1)
            while True:
                gap = high - found
                if not gap.any():
                    break
                middle = found + ((gap + 1) >> 1)
                up = model.cum.take(model.base_cum + middle) <= target
                found = np.where(up, middle, found)
                high = np.where(up, high, middle - (gap > 0))
            where = model.base_cum + found
            ids = np.where(two, model.guess2, np.where(one, model.guess1, found)).astype(_I)
            first = np.where(two, 0, np.where(one, model.a, model.spread(model.cum.take(where)))).astype(np.uint64)
            last = np.where(two, model.a, np.where(one, model.ab, model.spread(model.cum.take(where + 1)))).astype(np.uint64)
            code -= unit * first
            size = unit * (last - first)
            short = np.flatnonzero(size < _RENORM)
            if len(short):
                word = data.take(next_word[short], mode="clip")
                code[short] = (code[short] << _WORD) | (spare[short] << np.uint64(30)) | (word >> np.uint64(2))
                spare[short] = word & np.uint64(3)
                next_word[short] += 1
                size[short] <<= _WORD
            out[at + step] = ids
            model.update(ids)
    found = np.split(out, np.cumsum(sizes)[:-1])
    for ids, head in zip(found, heads):
        if zlib.crc32(ids.astype("<u4").tobytes()) != head[4]:
            raise ValueError("a block of token ids fails its checksum")
    return [ids.astype(np.uint32) for ids in found]
