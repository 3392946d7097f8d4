import hashlib

import numpy as np
import pytest

from gridpulse.llm import fingerprint as fp
from gridpulse.llm.common import WordHashes


@pytest.mark.parametrize("ranges", ["1", "4", "50"])
def test_odd_rows(spark, odd, none, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = [tuple(r) for r in fp.neighbours(odd).collect()]
        assert fp.neighbours(none).count() == 0
        alone = fp.neighbours(odd.where("doc_id = 8")).collect()
        nameless = fp.neighbours(odd.where("doc_id is null")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    hashes, want = WordHashes(), []
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        n = len(text) // 3
        other = (text[:-n] + following[:n]) if n else text
        a, b, c = (fp.sketch(x, hashes, 1 / 4) for x in (text, other, following))
        want.append((doc, len(text), hashlib.sha256(other.encode()).hexdigest(), fp.text_form(a), fp.text_form(b),
                     fp.containment(a, b), fp.containment(a, c)))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert alone[0]["near_next"] == 1.0 and nameless[0]["near_next"] == 1.0 and len(alone) == len(nameless) == 1


def test_estimates_follow_the_truth_and_parts_merge():
    rng, hashes = np.random.default_rng(0), WordHashes()
    words = [f"w{i}" for i in range(5000)]
    long, short = rng.choice(words, 6000).tolist(), rng.choice(words, 600).tolist()
    a, b = fp.sketch(" ".join(long + short), hashes), fp.sketch(" ".join(short[:300] + rng.choice(words, 300).tolist()), hashes)
    assert abs(fp.containment(a, b) - 0.5) < 0.12
    halves = [" ".join(long[:3004]), " ".join(long[3000:])]
    merged = fp.merge(*[fp.sketch(h, hashes) for h in halves])
    whole = fp.sketch(" ".join(long), hashes)
    assert len(np.setdiff1d(merged, whole)) <= 2 and len(np.setdiff1d(whole, merged)) == 0
    assert 0.22 < len(whole) / 6000 < 0.28
