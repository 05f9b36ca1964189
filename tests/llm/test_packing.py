import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import ODD_TEXTS, documents
from tokenizers import Tokenizer

from stratamill.llm.packing import pack, plan, slots
from stratamill.llm.tokens import TOKENIZER, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    found.encode_special_tokens = True
    return found


TEXTS = [
    *ODD_TEXTS,
    (30, "It's DON'T they'll 12.5% naïve co-op ... !!! ΣΊΣΥΦΟΣ İstanbul ǅ"),
    (31, "<|endoftext|> <|startoftext|>x é Å ﬁ"),
    (32, "Tab\tand\nline wide​none\x1cfile\x85next"),
]


def test_pieces_are_the_tokenizers_and_fit_without_gaps(spark, tokenizer):
    found = pack(documents(spark, TEXTS)).collect()
    want = defaultdict(int)
    for key, text, *_ in TEXTS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            want[key, piece, start, tuple(ids[start : start + 2048])] += 1
    got, filled = defaultdict(int), defaultdict(list)
    for r in found:
        got[r["doc_id"], r["piece"], r["start"], tuple(r["ids"])] += 1
        assert r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4"))
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_empty_table(spark):
    assert pack(documents(spark, [])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 200), max_size=20))
def test_plan_uses_every_piece_once(counts):
    fillings = plan(dict(counts), 32)
    used = defaultdict(int)
    for content, times in fillings:
        assert times > 0 and 0 < sum(content) <= 32
        for length in content:
            used[length] += times
    assert dict(used) == counts
    total = sum(times for _, times in fillings)
    volume = sum(k * n for k, n in counts.items())
    assert volume / 32 <= total <= 2 * volume / 32 + 1
    for length, (begins, _, _) in slots(fillings, 32).items():
        assert begins[0] == 0 and (np.diff(begins) > 0).all() and begins[-1] < counts[length]


def test_exact_complements_leave_no_gap():
    fillings = plan({1000: 7, 1048: 7, 600: 6, 700: 6, 748: 6, 512: 8}, 2048)
    assert all(sum(content) == 2048 for content, _ in fillings)
    assert sum(times for _, times in fillings) == 7 + 6 + 2
