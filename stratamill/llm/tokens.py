"""Token ids of whole texts, by a public tokenizer file, in Arrow batches.

A text's ids are its words' ids one after the other, because the tokenizer never joins
over white space. Words repeat a lot, so each worker remembers the ids of those it has
seen lately; everything per token is array work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
# Pieces of text that a task remembers, and bytes of their ids; beyond either all are forgotten.
REMEMBERED, REMEMBERED_BYTES = 400_000, 16 << 20
# Longer texts are tokenized in slices of about that size, cut at white space.
LONG_BYTES = 4 << 20
_BREAK = re.compile(rb"[\x20\x09-\x0D]")
# The tokenizer never joins a letter and a punctuation mark that follows it, but an
# apostrophe (which begins tokens of its own): a space between them changes nothing.
_LETTER, _MARK = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
_BETWEEN = f"([{_LETTER}])([{_MARK}])"
_ONE_KIND = f"^([{_LETTER}]+|[{_MARK}]+)$"
# Fixed value: how the names of special tokens begin; texts with it are not spaced.
_SPECIAL = "<|"
_END_OF_WORD = "</w>"
_TOGETHER = 512
_PLACES = 1 << 16


CHUNK_BYTES = 8 << 20


def chunks(batches: Iterator[pa.RecordBatch], column: int, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts in ``column`` have about ``most`` bytes; a longer text comes alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start, size = [], 0, 0
        for i, n in enumerate(sizes.tolist()):
            if size and size + n > most:
                ends.append((start, i))
                start, size = i, 0
            size += n
        for a, b in [*ends, (start, batch.num_rows)]:
            if b > a:
                yield batch.slice(a, b - a)


class WordIds:
    """Ids of pieces of text without white space; those of the last ones asked for are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_END_OF_WORD)]] = True
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.pool, self.lengths = np.zeros(0, self.kind), np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind) for e in encoded]

    def _encode_together(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and numbers of ids of pieces of one kind each, many of them encoded as one text.

        Ids that end a word tell them apart; where these are not as many, each is encoded alone.
        """
        groups = [pieces[i : i + _TOGETHER] for i in range(0, len(pieces), _TOGETHER)]
        ids, lengths = [], []
        for group, encoded in zip(groups, self._encode([" ".join(g) for g in groups]), strict=True):
            stops = np.flatnonzero(self.ends[encoded]) + 1
            if len(stops) == len(group):
                ids.append(encoded)
                lengths.append(np.diff(stops, prepend=0))
            else:
                alone = self._encode(group)
                ids += alone
                lengths.append(np.array([len(a) for a in alone]))
        return ids, lengths

    def _learn(self, new: pa.Array) -> None:
        plain = pc.match_substring_regex(new, _ONE_KIND)
        together, alone = new.filter(plain).to_pylist(), new.filter(pc.invert(plain)).to_pylist()
        ids, lengths = self._encode_together(together)
        odd = self._encode(alone)
        self.pool = np.concatenate([self.pool, *ids, *odd])
        more = np.concatenate([*lengths, [len(a) for a in odd]]).astype(np.int32)
        first = len(self.lengths)
        self.lengths = np.concatenate((self.lengths, more))
        self.starts = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        self.places.update(zip([*together, *alone], range(first, len(self.lengths)), strict=True))

    def of(self, pieces: pa.Array) -> np.ndarray:
        """Places of pieces in ``starts`` and ``lengths``, which tell their ids in ``pool``."""
        words = pieces.to_pylist()
        places = np.array([self.places.get(w, -1) for w in words], np.int64)
        unknown = places < 0
        if unknown.any():
            if len(self.places) + int(unknown.sum()) > REMEMBERED or self.pool.nbytes > REMEMBERED_BYTES:
                self.forget()
                unknown[:] = True
            new = pieces.filter(pa.array(unknown))
            self._learn(new.unique())
            places[unknown] = [self.places[w] for w in new.to_pylist()]
        return places


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def forget(path: str) -> None:
    """Give the memory of words back, at the end of a task: workers live on."""
    _word_ids(path).forget()
    pa.default_memory_pool().release_unused()


def _slices(text: pa.LargeStringScalar) -> Iterator[pa.Array]:
    """A long text in parts, as arrays of one text each; nothing is copied."""
    raw = text.as_buffer()
    start = 0
    while start < raw.size:
        found = _BREAK.search(memoryview(raw), start + LONG_BYTES)
        stop = found.start() if found else raw.size
        offsets = pa.array([0, stop - start], pa.int64()).buffers()[1]
        yield pa.Array.from_buffers(pa.large_string(), 1, [None, offsets, raw.slice(start, stop - start)])
        start = stop


def ids_of(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of texts in one array, and where each text's ids begin (and the last end)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 1 and len(texts[0].as_buffer() or b"") > LONG_BYTES:
        ids = np.concatenate([_ids_of(part, path)[0] for part in _slices(texts[0])])
        return ids, np.array([0, len(ids)])
    return _ids_of(texts, path)


def _ids_of(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    spaced = pc.replace_substring_regex(texts, _BETWEEN, r"\1 \2")
    words = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, _SPECIAL), texts, spaced))
    coded = words.flatten().dictionary_encode()
    of = _word_ids(path)
    # Lower case here: of a slice of an array, Arrow's function may give what is no text.
    places = of.of(pc.ascii_lower(coded.dictionary))[coded.indices.to_numpy(zero_copy_only=False)]
    lengths = of.lengths[places]
    ends = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    shift = of.starts[places] - ends[:-1]
    words_before = np.concatenate(([0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))))
    ids = np.empty(ends[-1], of.kind)
    # The places of single ids are eight times as large as the ids: some at a time.
    for a in range(0, len(places), _PLACES):
        b = min(a + _PLACES, len(places))
        take = np.repeat(shift[a:b], lengths[a:b]) + np.arange(ends[a], ends[b])
        ids[ends[a] : ends[b]] = of.pool[take]
    return ids, ends[words_before.astype(np.int64)]
