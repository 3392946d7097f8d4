import numpy as np
import pytest

from gridpulse.llm import toxicity as tox


def corpus(n=120):
    rng = np.random.default_rng(1)
    plain = ["house", "garden", "river", "stone", "cloud", "walk", "green", "paper", "music", "bread"]
    texts, labels = [], []
    for i in range(n):
        words = rng.choice(plain, rng.integers(5, 200)).tolist()
        if i % 3 == 0:
            words[int(rng.integers(len(words)))] = ["grumbler", "grumbling", "grumbled"][i % 9 // 3]
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return tox.train(*corpus(), buckets=1 << 12, epochs=10)


def test_finds_few_words_in_long_texts_and_unseen_spellings(model):
    scorer = tox.Scorer(model.direction(), float(model.bias[1] - model.bias[0]), model.windows, None)
    texts, labels = corpus()
    assert ((scorer(texts) >= 0.5) == np.array(labels, bool)).mean() > 0.97
    long = "house garden river stone " * 5000
    assert scorer([long])[0] < 0.5 <= scorer([long + "grumblings " + long])[0]


def test_scores_equal_a_plain_average_of_vectors(model):
    words = "house grumbler river".split()
    vectors = []
    for w in words:
        _, buckets = tox.subwords([w], len(model.vectors))
        vectors.append(model.vectors[buckets].mean(0))
    logits = (np.mean(vectors, 0) @ model.out).sum(0) + model.bias
    p = np.exp(logits) / np.exp(logits).sum()
    got = tox.Scorer(model.direction(), float(model.bias[1] - model.bias[0]), (3, 3), None)([" ".join(words)])
    assert got[0] == pytest.approx(p[1], abs=1e-5)


NAMES = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)]


def scored(model, texts):
    return tox.Scorer(model.direction(), float(model.bias[1] - model.bias[0]), model.windows, None)(texts) >= 0.5


def phrases(n, seed):
    """Toxic by three ordinary words together; clean texts hold two of the three together."""
    rng = np.random.default_rng(seed)
    phrase, texts, labels = ["lemon", "horse", "cloud"], [], []
    for i in range(n):
        words = rng.choice(NAMES, 60).tolist()
        at = int(rng.integers(50))
        words[at: at + 3] = rng.permutation(phrase) if i % 3 == 0 else [*rng.permutation(phrase)[:2], "stone"]
        texts.append(" ".join(words))
        labels.append(i % 3 == 0)
    return texts, np.array(labels)


def test_phrase_of_ordinary_words():
    texts, labels = phrases(600, 1)
    fitted = tox.train(texts, labels.astype(int).tolist(), buckets=1 << 16)
    texts, labels = phrases(300, 2)
    found = scored(fitted, texts)
    assert found[labels].mean() > 0.8 and found[~labels].mean() < 0.1
    texts, labels = phrases(600, 1)
    narrow = tox.train(texts, labels.astype(int).tolist(), windows=(1,), buckets=1 << 16)
    texts, labels = phrases(300, 2)
    assert (scored(narrow, texts) == labels).mean() < (found == labels).mean()


def test_rare_toxic_spellings():
    """Each of ten spellings without common n-grams stands in two sampled documents only."""
    odd = ["zqxjkvw", "bbytrmq", "ughhfpd", "kkloqce", "yvsnnax", "pfwzzib", "mmrgeoj", "ttdcluy", "xxiavhk", "jjobwes"]
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for i in range(360):
        words = rng.choice(NAMES, 40).tolist()
        if i % 3 == 0:
            words[int(rng.integers(40))] = odd[i // 6] if i < 60 else "grumbler"
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    fitted = tox.train(texts, labels, buckets=1 << 16)
    fresh = [" ".join([*rng.choice(NAMES, 30), word, *rng.choice(NAMES, 30)]) for word in odd]
    assert scored(fitted, fresh).mean() >= 0.8
    assert scored(fitted, [" ".join(rng.choice(NAMES, 60)) for _ in range(100)]).mean() < 0.1


def test_subwords_are_the_word_and_its_grams():
    owner, buckets = tox.subwords(["ab", "abcd"], 1 << 20)
    assert np.bincount(owner).tolist() == [1 + 2, 1 + 4 + 3 + 2]  # <ab>: two of 3; <abcd>: four of 3, three of 4, two of 5
    assert tox.subwords(["ab"], 1 << 20)[1].tolist() == buckets[owner == 0].tolist()


def test_odd_rows(spark, odd, none, model):
    got = tox.score(odd, model)
    assert set(got.columns) == set(odd.columns)  # the clashing column is replaced
    rows = {r["doc_id"]: r["score"] for r in got.collect()}
    assert rows[3] == rows[4] == rows[5] and all(0 <= s <= 1 for s in rows.values())
    assert tox.score(none, model).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, None), (8, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    fitted = tox.fit(odd, labels, epochs=2, buckets=1 << 10)
    assert fitted.constant is None
    assert tox.fit(odd, labels.where("toxic = 1")).constant == 1.0
    assert tox.fit(none, labels).constant == 0.0 == tox.fit(odd, labels.where("false")).constant


def test_held_out_accuracy(spark):
    from gridpulse.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = QUERIES["op9_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.97
    assert got.predicted[got.toxic == 1].mean() > 0.8 and got.predicted[got.toxic == 0].mean() < 0.01
