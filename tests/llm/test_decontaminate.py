import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridpulse.llm import decontaminate as dec


def semi_global(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=70), st.text("abc ", max_size=90))
def test_myers_equals_dynamic_programming(pattern, text):
    assert dec.myers(dec.peq(pattern), len(pattern), text)[0] == semi_global(pattern, text)


def test_every_occurrence_within_budget_is_found():
    rng = np.random.default_rng(0)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ora", "eli", "umo", "anti")]
    items = [(i, " ".join(rng.choice(words, 18))) for i in range(12)]
    matcher = dec.Matcher(items, 0.05, 24)
    for case in range(200):
        item, text = items[case % 12]
        pattern, budget = dec.normal(text), int(len(dec.normal(text)) * 0.05)
        chars = list(pattern)
        for _ in range(case % 9):
            at = int(rng.integers(len(chars)))
            kind = int(rng.integers(3))
            chars[at: at + (kind != 0)] = [] if kind == 1 else ["z"]
        doc = f"{' '.join(rng.choice(words, 40))} {''.join(chars)} {' '.join(rng.choice(words, 40))}"
        truth = semi_global(pattern, f" {dec.normal(doc)} ")
        found = {h[0]: h[1] for h in matcher.find(doc)}
        assert found.get(item) == (truth if truth <= budget else None)


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "Lazy dog, near the OLD river-bank today"), (2, None), (3, ""), (4, "one two"), (5, "wo tw"), (6, "--"),
                                   (1, "Lazy dog, near the OLD river-bank today")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["edits"]) for r in dec.matches(odd, items).collect())
    assert got == [(1, 1, 0)] * 4 + [(2, 1, 0)] * 2 + [(6, 4, 0)]
    passage = dec.matches(odd, items.where("item_id = 4")).first()["passage"]
    assert passage == "one two"
    assert dec.matches(none, items).count() == 0 == dec.matches(odd, items.where("false")).count()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in dec.matches(odd, items, slice_chars=5).collect()) == got


def test_query_finds_every_whole_passage(spark):
    from gridpulse.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], f" {dec.normal(r['text'])} ") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], dec.normal(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in docs for i, p in items if f" {p} " in t}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op1_decontamination"](spark, sf).where("edits = 0").collect()}
    assert want and want <= got
