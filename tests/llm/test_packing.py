import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from gridpulse.llm import packing
from gridpulse.llm.encoding import load

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("window", [16, 1024])
def test_every_id_lies_in_one_piece_and_nothing_is_padded(odd, none, window):
    t = load(PATH)
    docs = defaultdict(list)
    for r in odd.collect():
        docs[r["doc_id"]].append([*t.encode(r["text"] or "", add_special_tokens=False).ids, 0])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(odd, PATH, window=window, shard_docs=5).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(docs)
    for doc, copies in docs.items():
        ids = copies[0]
        got = sorted((r["start"], r["length"], r["ids_crc32"]) for r in pieces[doc])
        want, at = [], 0
        for start, length, _ in got[:: len(copies)] if len(copies) > 1 else got:
            want.append((start, length, zlib.crc32(np.array(ids[start: start + length], "<u4").tobytes())))
            at += length
        assert sum(r["length"] for r in pieces[doc]) == len(ids) * len(copies)
        if len(copies) == 1:
            assert got == want and [s for s, _, _ in got] == np.cumsum([0, *[n for _, n, _ in got]])[:-1].tolist()
        assert {r["doc_tokens"] for r in pieces[doc]} == {len(ids)}
    for own in sequences.values():
        own.sort()
        total = sum(n for _, n in own)
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()
        assert total == window or total & (total - 1) == 0
    assert packing.pack(none, PATH).count() == 0


def test_bm25_by_hand():
    docs = [np.array(d) for d in ([1, 2, 3, 3], [3, 4, 4], [1, 2, 9], [7], [])]
    index = packing.Index(docs)
    n, mean = 5, np.mean([4, 3, 3, 1, 0])

    def score(query, doc):
        s = 0.0
        for t in set(docs[query].tolist()):
            df = sum(t in d for d in docs)
            tf = (docs[doc] == t).sum()
            if df > 1:
                s += np.log(1 + (n - df + .5) / (df + .5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[doc]) / mean))
        return s

    unused = np.array([False, True, True, True, True])
    want = sorted((d for d in range(1, 5) if score(0, d) > 0), key=lambda d: -score(0, d))
    assert index.neighbours(0, unused, 24).tolist() == want == [2, 1]
    assert index.neighbours(4, unused, 24).tolist() == [] == index.neighbours(3, unused, 24).tolist()


def test_a_seed_takes_its_nearest_documents_first():
    topics = [np.arange(10) + 100 * (i % 3) for i in range(30)]
    left = np.full(30, 10)
    windows = list(packing.fill(left.copy(), packing.Index(topics), 50, 24))
    for seed, taken in windows[:4]:
        assert sum(n for _, n in taken) == 50
        assert all(d % 3 == seed % 3 for d, _ in taken[:5])
    assert sum(n for _, taken in windows for _, n in taken) == 300


@pytest.mark.parametrize("text", ["alpha beta gamma", "alpha\nbeta\ngamma", "alpha-beta/gamma", "alpha  beta  gamma", "  alpha\n    beta\n\tgamma",
                                  "alpha\xa0beta gamma", "alpha beta \n gamma", "ALPHA\r\n beta, gamma."])
def test_every_word_is_a_term_whatever_the_white_space(text):
    e = packing.encoder(PATH, blanks=True)
    terms = [e.terms_of(p) for p in e.parts_of([text, "alpha", "beta", "gamma"])]
    assert all(len(t) == 1 for t in terms[1:])
    assert {int(t[0]) for t in terms[1:]} <= set(terms[0].tolist())


def test_documents_meet_in_words_after_line_breaks_and_in_indented_texts():
    texts = ["first\nneedle\nx1", "second\nhay\nx2", "third  hay\n    stack", "other\n    needle  x4"]
    e = packing.encoder(PATH, blanks=True)
    index = packing.Index([e.terms_of(p) for p in e.parts_of(texts)])
    assert index.neighbours(0, np.array([False, True, True, True]), 24)[0] == 3
    assert index.neighbours(1, np.array([True, False, True, True]), 24)[0] == 2


def test_a_seed_is_scored_on_all_its_terms():
    seed = np.arange(100)
    rare = [np.array([i, 1000 + i]) for i in range(30)]  # the seed's rarest shared terms, of two documents each
    common = [np.arange(40, 100)] * 3
    index = packing.Index([seed, *rare, *common])
    found = index.neighbours(0, np.arange(34) > 0)
    assert set(found.tolist()) == set(range(1, 34))
    windows = list(packing.fill(np.array([10, *[1] * 30, *[10] * 3]), index, 40))
    assert sorted(d for d, _ in windows[0][1]) == [0, 31, 32, 33]


def test_used_documents_leave_the_index_and_change_no_order():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 30, rng.integers(0, 12)) for _ in range(300)]
    whole, index = packing.Index(docs), packing.Index(docs)
    unused = rng.random(300) < 0.4
    index.drop(unused)
    assert len(index.doc) < 0.5 * len(whole.doc)
    for doc in range(300):
        want = whole.neighbours(doc, unused).tolist()
        assert index.neighbours(doc, unused).tolist() == want
        few = index.neighbours(doc, unused, most=5).tolist()
        assert few == want[: len(few)] and len(few) >= min(5, len(want))
    windows = list(packing.fill(np.full(300, 3), index := packing.Index(docs), 10))
    assert sum(n for _, taken in windows for _, n in taken) == 900 and len(index.doc) < 0.3 * len(whole.doc)
