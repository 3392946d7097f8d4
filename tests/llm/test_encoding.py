import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridpulse.llm.encoding import Encoder

ODD = ["", " ", "  ", "a  b\n c", "x \n", "\n\nx y\n", "\0a \0b", "don't  DON'T it's x's", " lead", "trail ", "Σ ΑΣ İx", "a\x1cb <|endoftext|> c",
       "ñandú ñ 中文 字", "éa é, x́", "a.b. c... d!? 12,5 (x)", " a  b", "🙂 🙂🙂", "word." * 40, "ab" * 3000]


@pytest.fixture(scope="module")
def encoders():
    return [Encoder(public_tokenizers.path("word_bpe_49k.json"), False, limit=300), Encoder(public_tokenizers.path("byte_bpe_50k.json"), True, limit=300)]


def same(encoder, texts):
    for text, parts in zip(texts, encoder.parts_of(texts)):
        want = encoder.tokenizer.encode(text, add_special_tokens=False)
        assert encoder.ids_of(parts).tolist() == want.ids
        if encoder.blanks:
            begins, ends = encoder.spans_of(parts)
            assert list(zip(begins.tolist(), ends.tolist())) == want.offsets


def test_odd_texts(encoders):
    for e in encoders:
        same(e, ODD)
        same(e, ODD)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(st.sampled_from("abcXY .,'\n\téß1́-"), max_size=40), max_size=4))
def test_any_text(encoders, texts):
    for e in encoders:
        same(e, texts)


def test_without_spans_the_ids_are_the_same():
    texts = ["Plain words, l'été isn't over", " naïve  x9 abcéf ǅ 12", "a\n b", "", None, "end."] + [f"w{i} wordy{chr(97 + i % 26) * (i % 7)}" for i in range(300)]
    for name, blanks in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        full, short = (Encoder(public_tokenizers.path(name), blanks, spans=s) for s in (True, False))
        for text, a, b in zip(texts, full.parts_of(texts), short.parts_of(texts)):
            want = full.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert full.ids_of(a).tolist() == short.ids_of(b).tolist() == want
            assert full.terms_of(a).tolist() == short.terms_of(b).tolist()
        assert short.piece_begin.size == 0 and (full.piece_begin.size > 0) == blanks
