import numpy as np
import public_tokenizers
import pytest

from gridpulse.llm import tokencounts as tc
from gridpulse.llm.encoding import load

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(spans, sections, rule):
    counts, crossing = [0] * len(sections), [0] * len(sections)
    for b, e in spans:
        shares = [max(0, min(e, s[2]) - max(b, s[1])) for s in sections]
        if not any(shares):
            continue
        first = [i for i, s in enumerate(sections) if s[1] <= b < s[2]]
        best = first[0] if rule == "first" and first else shares.index(max(shares))
        counts[best] += 1
        crossing[best] += max(shares) < e - b
    return counts, crossing


@pytest.mark.parametrize("rule", ["first", "largest"])
def test_merge_equals_brute_force(rule):
    rng = np.random.default_rng(0)
    for _ in range(300):
        cuts = np.unique(rng.integers(0, 60, 25))
        spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        edges = np.unique(rng.integers(0, 60, 9)).tolist()
        pairs = list(zip(edges[:-1], edges[1:])) if rng.integers(2) else list(zip(edges[::2], edges[1::2]))
        sections = [("x", a, b) for a, b in pairs]
        if not spans or not sections:
            continue
        got = tc.attribute(np.array([s[0] for s in spans]), np.array([s[1] for s in spans]), sections, rule)
        assert (got[0].tolist(), got[1].tolist()) == brute(spans, sections, rule)


def test_sections_cover_the_text():
    text = "Title one. More of it\n| a | b |\n| c | d |\n\n- x\n- y\nEnd"
    found = tc.sections_of_lines(text)
    assert [k for k, _, _ in found] == ["lead", "prose", "table", "blank", "list", "prose"]
    assert found[0][2] == 11 and all(a[2] == b[1] for a, b in zip(found, found[1:])) and found[-1][2] == len(text)


def test_odd_rows(odd, none):
    t, got = load(PATH), {}
    for r in tc.count(odd, PATH).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for r in odd.where("doc_id <> 1 or doc_id is null").collect():
        text = r["text"] or ""
        spans = t.encode(text, add_special_tokens=False).offsets
        rows = sorted(got[r["doc_id"]], key=lambda x: x["section"])
        want = brute(spans, tc.sections_of_lines(text), "largest")
        assert ([x["n_tokens"] for x in rows], [x["n_crossing"] for x in rows]) == want
        assert {x["doc_tokens"] for x in rows} == {len(spans)} and sum(want[0]) == len(spans)
    assert len(got[3]) == len(got[4]) == 1 and got[3][0]["kind"] == "blank"
    assert tc.count(none, PATH).count() == 0
