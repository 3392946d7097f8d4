import re
import tracemalloc
from pathlib import Path

import numpy as np

from gridpulse.llm import langid
from gridpulse.llm.common import give_back


def test_grams_by_hand():
    letters = langid.letter_flags()
    a, b = (langid.grams(t, letters, 1 << 15) for t in ("Ab-- 1c", "ab c"))
    assert a.tolist() == b.tolist()  # case and other than letters do not matter
    assert len(a) == 6 + 5 + 4  # " ab c "
    assert langid.grams("12 -", letters, 1 << 15) is None


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3)) * 2
    truth = np.array([rng.choice(3, p=langid.softmax(r)) for r in z])
    assert abs(langid.temperature(z * 5, truth) - 5) < 0.6


def test_odd_rows(spark, odd, none):
    model = langid.fit(odd)
    assert model.languages == ("de", "en")
    got = langid.predict(odd, model)
    assert set(got.columns) == {*odd.columns, "lang_pred"}
    rows = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert {rows[i] for i in (3, 4, 5, 7)} == {("und", 0.0)}
    assert all(0 < rows[i][1] <= 1 for i in (1, 2, 6, 8, 9, 10, None))
    assert langid.predict(none, model).count() == 0
    empty = langid.fit(none)
    assert {r["lang_pred"] for r in langid.predict(odd, empty).collect()} == {"und"}


def test_document_frequencies_cover_every_document(spark, odd):
    texts = [r["text"] for r in odd.collect()]
    letters, want, total = langid.letter_flags(), np.zeros(1 << 10, int), 0
    for t in texts:
        g = langid.grams(t, letters, 1 << 10) if t else None
        if g is not None:
            want[np.unique(g)] += 1
            total += 1
    df, n = langid.document_frequencies(odd.repartition(3), "text", 1 << 10)
    assert df.tolist() == want.tolist() and n == total


def test_held_out_accuracy(spark):
    from gridpulse.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op5_language_id"](spark, sf).where("held_out").join(truth, "doc_id").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97 and got.score.between(0, 1).all()


def test_training_holds_the_grams_of_one_text_at_a_time():
    texts = ["une phrase assez longue " * 1500, "a rather long sentence " * 1500] * 30
    tracemalloc.start()
    model = langid.train(texts, ["fr", "en"] * 30, np.ones(1 << 10, np.float32), epochs=1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.languages == ("en", "fr")
    assert most < 12e6  # those of all texts are 25 MB


def test_freed_memory_goes_back_to_the_system():
    def held():
        return int(re.search(r"VmRSS:\s*(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    chunks = [np.ones(2000) for _ in range(20_000)]  # 16 KB each: from the allocator's heap
    last, before = np.ones(2000), held()
    del chunks
    give_back()
    assert before - held() > 250 and last.all()
