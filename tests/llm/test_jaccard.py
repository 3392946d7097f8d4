import numpy as np
import pytest

from gridpulse.llm import jaccard
from gridpulse.llm.common import WORD, connected


def brute(rows, similarity=0.8, k=5):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").lower())
        sets.append({tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    n = len(rows)
    links, group = [0] * n, list(range(n))
    for a in range(n):
        for b in range(a + 1, n):
            union = len(sets[a] | sets[b])
            if union and len(sets[a] & sets[b]) >= similarity * union:
                links[a] += 1
                links[b] += 1
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    ids = [i for i, _ in rows]
    return {ids[i]: (min(ids[j] for j in range(n) if group[j] == group[i]), links[i]) for i in range(n)}


def near_copies(seed=4):
    rng = np.random.default_rng(seed)
    rows, words = [], [f"w{i}" for i in range(3000)]
    for base in range(12):
        text = rng.choice(words, 150).tolist()
        for copy in range(int(rng.integers(1, 9))):
            own = list(text)
            for _ in range(copy):
                own[int(rng.integers(len(own)))] = f"e{rng.integers(10 ** 6)}"
            rows.append((len(rows) * 3 + 1, " ".join(own)))
    rows += [(1000, rows[0][1].upper()), (1001, rows[5][1])]
    return rows


@pytest.mark.parametrize("block", [3, 256])
def test_equals_brute_force(spark, block):
    rows = near_copies()
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.join(
        spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()}
    assert got == brute(rows)


def test_recall_just_above_the_similarity(spark):
    """Pairs that share 0.8 to 0.83 of their shingles, the hardest to meet: at least 99 of 100 are found."""
    rng = np.random.default_rng(8)
    rows = []
    for pair in range(400):
        text = [f"p{pair}w{i}" for i in rng.integers(0, 10 ** 6, 190)]
        cut = int(rng.integers(17, 21))  # the first words of one text are others in the other: a run of cut shingles differs
        rows += [(2 * pair, " ".join(text)), (2 * pair + 1, " ".join([f"q{pair}x{i}" for i in range(cut - 4)] + text[cut - 4:]))]
    want = brute_pairs(rows)
    got = {r["doc_id"]: r["n_texts"] for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 350 and sum(got[a] for a, _ in want) >= 0.99 * len(want)
    assert all(got[a] == 0 for a in got if a % 2 == 0 and (a, a + 1) not in want)


def brute_pairs(rows, similarity=0.8):
    found = []
    for (a, x), (b, y) in zip(rows[::2], rows[1::2]):
        x, y = ({tuple(w[i: i + 5]) for i in range(len(w) - 4)} for w in (x.split(), y.split()))
        if len(x & y) >= similarity * len(x | y):
            found.append((a, b))
    return found


def test_chain_is_cut_into_blocks_that_meet(spark):
    """Each text shares most of its words with the next one only; blocks of any size give the links of the pairs."""
    words = [f"c{i}" for i in range(700)]
    rows = [(i, " ".join(words[6 * i: 6 * i + 100])) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for block in (4, 1024):
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.join(docs, block=block).collect()}
        assert got == want


def test_long_posting_lists_and_heavy_texts(spark):
    """Sixty copies, each with one word of its own, cut by the number of shingles in a block."""
    words = [f"h{i}" for i in range(200)]
    rows = [(i, " ".join(words[:i + 20] + [f"own{i}"] + words[i + 21:])) for i in range(60)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.join(
        spark.createDataFrame(rows, "doc_id long, text string"), block_shingles=3000).collect()}
    assert got == brute(rows)


def test_links_of_sets_equal_brute_force():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 14, rng.integers(1, 12))).astype(np.uint64) for _ in range(40)]
    for left, right in ((sets, None), (sets[:15], sets[15:])):
        a, b = jaccard.linked(left, right, 0.5)
        other = left if right is None else right
        want = {(i, j) for i in range(len(left)) for j in range(len(other)) if (right is not None or i < j)
                and len(np.intersect1d(left[i], other[j])) >= 0.5 * len(np.union1d(left[i], other[j]))}
        assert set(zip(a.tolist(), b.tolist())) == want


def test_depth_keeps_the_recall():
    d = jaccard.forest_depth(0.8, 24, 0.999, 8)
    assert 1 - (1 - 0.8 ** d) ** 24 >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** 24


def test_odd_rows(odd, none):
    rows = jaccard.join(odd).collect()
    assert len(rows) == odd.count()
    got = {r["doc_id"]: (r["copy_of"], r["class_id"], r["n_links"]) for r in rows}
    assert got[1] == (1, 1, 2) and got[2] == (1, 1, 2)
    assert all(got[i] == (i, i, 0) for i in (3, 4, 5, 6, 7, 9)) and got[8] == got[10] == (8, 8, 1)
    assert jaccard.join(none).count() == 0


def test_connected_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (200, 100)]
    got = {r["node"]: r["label"] for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}
