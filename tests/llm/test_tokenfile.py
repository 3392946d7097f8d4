import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridpulse.llm import idcoder, tokenfile
from gridpulse.llm.encoding import load
from gridpulse.scratch import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=300), max_size=4))
def test_round_trip(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    got = idcoder.decode(idcoder.encode(blocks, 41))
    assert [g.tolist() for g in got] == [b.tolist() for b in blocks]


def test_repetition_and_skew_compress_and_large_ids_survive():
    rng = np.random.default_rng(0)
    again = np.tile(rng.integers(0, 100_000, 400), 100).astype(np.uint32)
    skewed = np.minimum(rng.geometric(0.05, 40_000), 99_999).astype(np.uint32)
    spread = rng.integers(0, 100_000, 40_000).astype(np.uint32)
    for ids, bits in ((again, 5), (skewed, 7), (spread, 18)):
        coded = idcoder.encode([ids], 100_000)
        assert (idcoder.decode(coded)[0] == ids).all() and 8 * len(coded[0]) / len(ids) < bits


def test_damage_is_noticed():
    coded = bytearray(idcoder.encode([np.arange(500, dtype=np.uint32)], 500)[0])
    coded[-200] ^= 1
    with pytest.raises(ValueError):
        idcoder.decode([bytes(coded)])


def test_combined_checksums():
    a, b = b"some bytes" * 50, b"others" * 77
    assert tokenfile.combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert tokenfile.combine(zlib.crc32(a), 0, 0) == zlib.crc32(a)


@pytest.mark.parametrize("block_ids", [64, 1 << 17])
def test_odd_rows(spark, odd, none, block_ids):
    path, t = new_path(spark, "odd-ids"), load(PATH)
    tokenfile.write(odd, path, PATH, end_id=1, block_ids=block_ids, together=5)
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""), r["doc_id"], r["text"] or "")
                  for r in odd.collect())
    want, at = [], 0
    for _, doc, text in rows:
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        want.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = sorted((tuple(r) for r in tokenfile.digests(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()),
                 key=lambda r: r[1])
    assert got == want
    pieces = sorted(tokenfile.read(spark, path).where("doc_id = 8").collect(), key=lambda r: r["start"])
    assert [i for p in pieces for i in p["ids"]] == [*t.encode(rows[9][2] if rows[9][1] == 8 else
                                                             next(x for _, d, x in rows if d == 8), add_special_tokens=False).ids, 1]
    empty = new_path(spark, "no-ids")
    tokenfile.write(none, empty, PATH, end_id=1)
    assert tokenfile.digests(spark, empty).count() == 0
