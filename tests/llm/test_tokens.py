"""Ids of remembered words against the tokenizer itself."""

import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import stratamill.llm.tokens as tokens

PATH = tokens.tokenizer_path()
PARTS = [
    "Don't", "it'S!", "word", "Word,", "É.", "été's", "x×!", "<|endoftext|>", "<|", "|>", "a<|startoftext|>b", "12ab,",
    "(a)", "...", "’s", "漢字.", "ß!", "İ,", "é!", "≠", "!́a", "K.", "\x1c", "\x85", "\xa0", "ΣΑΣ,",
    " ", "  ", "\t", "\n", "\r\n", "a" * 80, "!" * 40, "co-op", "a.b,c!d", "'", "''s", "\U0001f600", "ſ.", "ǅ,",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def all_ids(texts):
    ids, starts = tokens.ids_of(pa.array(texts, pa.string()), PATH)
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)), max_size=5))
@example(["a<|endoftext|>,b!", None, "", "Plain, text."])
def test_ids_are_the_tokenizers(plain, texts):
    assert all_ids(texts) == [plain(text) for text in texts]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(plain, text):
    assert all_ids([text]) == [plain(text)]


def test_long_texts_in_slices_and_short_memory(plain, monkeypatch):
    monkeypatch.setattr(tokens, "LONG_BYTES", 50)
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    text = "".join(PARTS[i * 7 % len(PARTS)] + " " * (i % 3) for i in range(800))
    assert all_ids([text]) == [plain(text)]
    assert all_ids([text[:70], text]) == [plain(text[:70]), plain(text)]
    tokens.forget(PATH)
    assert all_ids(["again"]) == [plain("again")]


def test_slices_of_a_larger_array(plain):
    texts = [f"Some TEXT, number {i}." for i in range(500)]
    array = pa.array(texts).slice(200, 100)
    ids, starts = tokens.ids_of(array, PATH)
    assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [plain(t) for t in texts[200:300]]
