"""Alignment against a plain version: whole texts encoded, cuts found by sets of offsets, pairs counted in dictionaries."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gridpulse.llm import alignment, queries

PATHS = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    values = alignment.byte_values()

    def tokens(text):
        """(id, first byte, end) of both sides; none where a side changes the text."""
        if not text:
            return [], []
        whole, out = (" " + text).encode(), []
        ids = a.encode(" " + text, add_special_tokens=False)
        sides = [[(i, bytes(values[c] for c in t)) for i, t in zip(ids.ids, ids.tokens)],
                 [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                  for i in b.encode(text)]]
        for side in sides:
            if b"".join(raw for _, raw in side) != whole:
                return [], []
            at, spans = 0, []
            for i, raw in side:
                spans.append((i, at, at + len(raw)))
                at += len(raw)
            out.append(spans)
        return out

    def groups(text):
        left, right = tokens(text)
        cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
        out = [([], []) for _ in cuts]
        for k, side in enumerate((left, right)):
            for i, _, end in side:
                out[bisect.bisect_left(cuts, end)][k].append(i)
        return out

    def rows(docs):
        found = [(doc, groups(text)) for doc, text in docs]
        links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for _, g in found]
        counts = Counter(pair for own in links for pair in own)
        most = {}
        for (x, _), n in counts.items():
            most[x] = max(most.get(x, 0), n)
        out = []
        for (doc, g), own in zip(found, links):
            text = ";".join(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}" for ga, gb in g)
            out.append((doc, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()),
                        sum(n for p, n in own.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in own.items()),
                        hashlib.sha256(text.encode()).hexdigest() if g else ""))
        return out

    return rows


def same(got, want):
    order = lambda rows: sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))
    assert order(got) == order(want)


def test_terminals_by_hand():
    # |ab|cd|e|f  and  |a|bcd|ef|: groups abcd and ef
    assert alignment.terminals(np.array([2, 4, 5, 6]), np.array([1, 4, 6])).tolist() == [1, 1, 3, 3, 1, 1, 3]
    assert alignment.terminals(np.array([], int), np.array([], int)).tolist() == []


def test_a_chain_of_overlaps_is_one_group():
    n = 5000  # ends 3, 5, 7, .. against 2, 4, 6, ..: only the last end is shared
    a = np.append(np.arange(3, 2 * n, 2), 2 * n)
    assert set(alignment.terminals(a, np.arange(2, 2 * n + 1, 2)).tolist()) == {len(a) - 1}


def test_whole_table(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    same(queries.QUERIES["op11_token_alignment"](spark, sf).select(*NAMES).collect(), plain([(r["doc_id"], r["text"]) for r in docs]))


def _texts():
    draw = random.Random(4)
    bits = ["foo", "Bar's", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "▁", "​", "12", "3.5", "--", "<s>", "<0x0A>", "<|endoftext|>", "</s>",
            "é", "中文", "\U0001f926\U0001f3fc‍♂️", "İ", "ﬁ", "é", "\x00", "\x1c", "\x85", "　", "word word", "a" * 40, " " * 9,
            "'ll", ".", "I'm", " ", "﻿", "_", "=====" * 8]
    return ["", " ", "\n", "a", " a", "a ", "\na", *["".join(draw.choices(bits, k=draw.randint(1, 25))) for _ in range(600)]]


def test_odd_texts(spark, plain):
    docs = [*enumerate(_texts()), (5, None), (None, "a row without an id"), (7, "copy copy"), (7, "copy copy"), (8, "copy copy")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = alignment.digests(df, *PATHS).select(*NAMES).collect()
    same(got, plain(docs))
    assert sum(r["n_a"] > 0 for r in got) > 150


@pytest.mark.parametrize("share", [1, 50, 10_000])
def test_many_pairs_join_by_a_shuffle(spark, odd, plain, share):
    want = plain([(r["doc_id"], r["text"]) for r in odd.collect()])
    same(alignment.digests(odd, *PATHS, most_rows=0, share=share).select(*NAMES).collect(), want)


def test_parts_are_forgotten_and_found_again():
    both = alignment.Aligner(*PATHS, limit=3)
    first = both.parts_of(["one two three four five six"])[0]
    kept = [both.texts[i] for i in first]
    again = both.parts_of(["six one", "two"])
    assert len(both.parts) == 3 and [both.texts[i] for i in again[0]] == [kept[5], kept[0]]


def test_long_group_has_distinct_pairs_only(spark, plain):
    docs = [(1, " " * 2000 + "x"), (2, "=" * 1001 + "\t" * 300), (3, "ab" * 500)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    same(alignment.digests(df, *PATHS).select(*NAMES).collect(), plain(docs))


def test_no_rows(none):
    assert alignment.digests(none, *PATHS).collect() == []
    assert alignment.digests(none, *PATHS, most_rows=-1).collect() == []
