import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridpulse.llm import gru, lmscore

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = {"head_words": 40, "endings": 5, "hidden": 6, "rounds": 1, "warm_docs": 50}


def tiny(seed=0):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 50, (3, gru.CLASS_WORDS)).astype(float)
    counts[2, 20:] = 0
    class_counts = np.concatenate([counts.sum(1), [30.0, 9.0]])
    return gru.start(3 * gru.CLASS_WORDS + 4, class_counts, counts, 6)


def data(rng, n=5, steps=12):
    classes = rng.integers(0, 5, (n, steps))
    words = np.where(classes < 3, rng.integers(0, 20, (n, steps)), 0)
    return rng.integers(0, 98, (n, steps)), classes, words, rng.integers(1, steps + 1, n)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    w = tiny()
    w = gru.Weights(*[a.astype(np.float64) for a in w.arrays()])
    inputs, classes, words, lens = data(rng)
    on = np.arange(12)[None] < lens[:, None]

    def loss(v):
        t = gru.Trainer(gru.Weights(*[a.copy() for a in v.arrays()]), window=12, rate=0.0)
        return t._window(inputs, classes, words, on, np.zeros((5, 6)))[1] / on.sum()

    trainer = gru.Trainer(gru.Weights(*[a.copy() for a in w.arrays()]), window=12, rate=0.0)
    trainer._window(inputs, classes, words, on, np.zeros((5, 6)))
    for k in range(6):
        grad = trainer.m[k] * 10  # the first moment after one step
        flat = np.argsort(-np.abs(grad), axis=None)[:4]
        for i in flat:
            at = np.unravel_index(i, grad.shape)
            up, down = (gru.Weights(*[a.copy() for a in w.arrays()]) for _ in range(2))
            up.arrays()[k][at] += 1e-5
            down.arrays()[k][at] -= 1e-5
            assert grad[at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=2e-3, abs=1e-6)


def test_scores_carry_the_state_over_windows():
    rng = np.random.default_rng(2)
    w, lens = tiny(), np.array([70, 1, 33, 5, 32])
    total = lens.sum()
    inputs, classes = rng.integers(0, 98, total), rng.integers(0, 5, total)
    words = np.where(classes < 3, rng.integers(0, 20, total), 0)
    got = gru.score_sequences(w, inputs, classes, words, lens, window=8, together=2)
    at = 0
    for n, value in zip(lens, got):
        h, want = np.zeros((1, 6), np.float32), 0.0
        for i in range(at, at + n):
            h = gru.step(w, w.table[inputs[i: i + 1]], h)[0]
            want += gru.log_probs(w, h, classes[i: i + 1], words[i: i + 1])[0]
        assert value == pytest.approx(want, rel=1e-4)
        at += n


def test_probabilities_of_a_step_sum_to_one():
    w, h = tiny(), np.random.default_rng(3).standard_normal((1, 6)).astype(np.float32)
    p = sum(np.exp(gru.log_probs(w, h, np.array([c]), np.array([k]))[0]) for c in range(3) for k in range(gru.CLASS_WORDS))
    p += sum(np.exp(gru.log_probs(w, h, np.array([c]), np.array([0]))[0]) for c in (3, 4))
    assert p == pytest.approx(1, abs=1e-4)


def test_training_lowers_the_loss():
    w, trainer = tiny(), None
    inputs = np.tile(np.arange(12), (16, 1))
    classes, words, lens = np.zeros_like(inputs), (inputs + 1) % 20, np.full(16, 12)
    trainer = gru.Trainer(w, window=4, rate=0.02)
    losses = [trainer.sequences(inputs, classes, words, lens) for _ in range(80)]
    assert losses[-1] < 0.3 * losses[0]


def check_counts(docs, got):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    tokens = [(d, WORDS.findall((t or "").translate(lower)) + [None]) for d, t in docs]
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = Counter(w for d, t in tokens if not out(d) for w in t)
    total, distinct = sum(c.values()), len(c)
    want = sorted((d is not None, d or 0, out(d), len(t), sum(c[w] > 0 for w in t), total,
                   round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in t), 4)) for d, t in tokens)
    have = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 4)) for r in got)
    assert have == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_odd_rows(odd, none):
    got = lmscore.score(odd, block_chars=60_000, **SMALL).collect()
    check_counts([(r["doc_id"], r["text"]) for r in odd.collect()], got)
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert lmscore.score(none, **SMALL).count() == 0
    held = odd.where("crc32(cast(cast(coalesce(doc_id, 0) as string) as binary)) % 7 = 2 and doc_id is not null")
    check_counts([(r["doc_id"], r["text"]) for r in held.collect()], lmscore.score(held, **SMALL).collect())


def test_better_than_its_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = lmscore.score(docs, warm_docs=150, rounds=1, head_words=640, hidden=12).collect()
    check_counts([(r["doc_id"], r["text"]) for r in docs.collect()], got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_training_sees_every_word_of_long_documents(spark):
    words = [f"w{i:03}" for i in range(500)]
    docs = spark.createDataFrame([(1, " ".join(words)), (None, "w000 w001"), (2, None)], "doc_id long, text string")
    head = {w.encode(): i for i, w in enumerate(words)}
    v = lmscore.Vocabulary(head, {}, np.ones(1), np.ones(1), 505, 501, np.ones(500))
    w = lmscore.first_weights(v, 6)
    after = lmscore.averaged(docs, w.like(w.flat()), v, rate=2e-3)
    assert (after.table[:500] != w.table[:500]).any(1).all()


def test_windows_cover_every_word_once_and_carry_the_state():
    texts = ["a b " * 50, None, "", "c", "a " * 31, "b " * 64 + "c"]
    v = lmscore.Vocabulary({b"a": 0, b"b": 1, b"c": 2}, {}, np.ones(1), np.ones(1), 9, 4, np.ones(3))
    held, got = {}, []
    for live, goes_on, inputs, classes, words, on in gru.windows_of(lmscore.walks(iter([texts[:4], texts[4:]]), v, 1000), 2, 32):
        for lane, old, *row, n in zip(live, goes_on, inputs, classes, words, on.sum(1)):
            if not old:
                held[lane] = ([], [])
                got.append(held[lane])
            held[lane][0].extend(row[0][:n])
            held[lane][1].extend(zip(row[1][:n], row[2][:n]))
    want = []
    for text in texts:
        own = lmscore.words_of(text)
        symbol, cls, word, _ = v.symbols(own, None)
        want.append(([4, *symbol[:-1]], list(zip(cls, word))))
    assert sorted(got) == sorted(want)
