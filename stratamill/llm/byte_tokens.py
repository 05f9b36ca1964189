"""Ids of texts by a byte-level BPE tokenizer file.

The merges of such a file are the order of its ids, which a faster encoder reads from
the rank file beside it; the ids are the same. Long texts are encoded in slices, cut
where the tokenizer always begins a new token: at a single space between word
characters. A slice without such a place is encoded as it is, by the file itself if it
is long.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
SLICE = 1 << 18
# Runs without a place to cut beyond which the faster encoder's stack may not do.
LONG_RUN = 1 << 19
_CUT = re.compile(r"(?<=\w) (?=\w)")


class ByteIds:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        ranks = f"{os.path.splitext(path)[0]}.tiktoken"
        self.fast = None
        if os.path.exists(ranks):
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def _slice_ids(self, text: str) -> list[int]:
        if self.fast is None or len(text) > LONG_RUN:
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def of(self, text: str, slice_chars: int = SLICE) -> np.ndarray:
        """Ids as unsigned 32-bit numbers."""
        if len(text) <= slice_chars:
            return np.array(self._slice_ids(text), "<u4")
        parts = [np.array(self._slice_ids(part), "<u4") for part in slices(text, slice_chars)]
        return np.concatenate(parts)


def slices(text: str, chars: int) -> Iterator[str]:
    """The text in parts that are encoded independently of each other, of about ``chars`` characters."""
    start = 0
    while len(text) - start > chars:
        cut = _CUT.search(text, start + chars)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


@lru_cache(maxsize=2)
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)
