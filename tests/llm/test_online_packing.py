import zlib
from collections import defaultdict

import numpy as np
import pytest
from odd import ODD_TEXTS, documents
from tokenizers import Tokenizer

from stratamill.llm.byte_tokens import TOKENIZER, ByteIds, byte_ids, slices
from stratamill.llm.online_packing import Piece, Windows, pack_online, powers_of_two
from stratamill.llm.tokens import tokenizer_path

ODD = [
    *ODD_TEXTS,
    (20, "it's’s  x 　y <|endoftext|> 12½ ²³ x'LL 'll A'S\x1c z\x85w"),
    (21, "漢字" * 3000),
    (22, " \n\t" * 3000),
    *[(100 + i, f"document {i} of many words " * (i % 37)) for i in range(300)],
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, plain, capacity):
    """Every id of every document in one piece, gapless sequences; returns the padding."""
    ids_of = {i: plain(text) for i, (_, text) in enumerate(texts)}
    docs = defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
    for key in {k for k, _ in texts}:
        wanted = sorted(ids for i, ids in ids_of.items() if texts[i][0] == key)
        pieces = sorted(docs.pop(key), key=lambda r: r["start"])
        for r in pieces:
            assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        if len(wanted) == 1:
            assert [x for r in pieces for x in r["ids"]] == wanted[0]
            at = 0
            for r in pieces:
                assert (r["start"], r["doc_tokens"]) == (at, len(wanted[0]))
                at += r["length"]
        else:
            assert sum(r["length"] for r in pieces) == sum(map(len, wanted))
    assert not docs
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


@pytest.mark.parametrize("capacity, windows, parts", [(1024, 32, 1), (64, 4, 5), (64, 1, 70)])
def test_exact_round_trip_with_little_padding(spark, plain, capacity, windows, parts):
    df = documents(spark, ODD).repartition(parts)
    rows = pack_online(df, capacity=capacity, windows=windows).collect()
    padding = check(rows, [(k, t) for k, t, *_ in ODD], plain, capacity)
    assert padding < 0.05 * sum(r["length"] for r in rows)


def test_same_rows_without_ids(spark):
    df = documents(spark, ODD).coalesce(1)
    with_ids = pack_online(df, capacity=64, windows=4)
    without = pack_online(df, capacity=64, windows=4, with_ids=False)
    assert without.columns == "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    assert sorted(map(str, without.collect())) == sorted(map(str, with_ids.drop("ids").collect()))


def test_empty_table(spark):
    assert pack_online(documents(spark, [])).count() == 0


def test_best_fit_then_the_fullest_goes():
    state = Windows(10, 2, 3)
    sizes = iter(range(100))

    def add(n):
        return [[len(p.ids) for p in w] for w in state.add(Piece(next(sizes), 0, np.zeros(n, "<u4"), n))]

    assert add(6) == [] and add(5) == []
    assert add(4) == [[6, 4]]  # best fit, not the emptiest
    assert add(8) == []
    assert add(7) == [[8]]  # a gap of two is padded; none has room for seven
    assert add(9) == [[7, 3]]  # a gap of three is filled by the head
    assert add(25) == [[10], [10], [5, 5]]
    assert [[len(p.ids) for p in w] for w in state.left()] == [[6]]


def test_rest_is_cut_at_powers_of_two():
    pieces = [Piece(1, 0, np.arange(300, dtype="<u4"), 301), Piece(2, 5, np.arange(401, dtype="<u4"), 406)]
    parts = list(powers_of_two(pieces))
    assert [sum(len(p.ids) for p in part) for part in parts] == [512, 128, 32, 16, 8, 4, 1]
    assert [x for part in parts for p in part for x in p.ids] == [*range(300), *range(401)]


def test_slices_are_encoded_as_the_whole_text(plain):
    encoder = byte_ids(tokenizer_path(TOKENIZER))
    text = " ".join(f"Wort{i} it's  a\n x" if i % 7 else "漢字 か　な ½" for i in range(3000)) + "!" * 5000 + " the end"
    assert "".join(slices(text, 50)) == text and len(list(slices(text, 50))) > 100
    assert [*encoder.of(text, 50), 0] == plain(text)


def test_long_runs_take_the_slow_way(plain, monkeypatch):
    monkeypatch.setattr("stratamill.llm.byte_tokens.LONG_RUN", 1000)
    encoder = ByteIds(tokenizer_path(TOKENIZER))
    for text in (" " * 5000, "a" * 5000, "short"):
        assert [*encoder.of(text, 100), 0] == plain(text)


def test_padding_over_the_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack_online(df.repartition(9, "doc_id"), with_ids=False).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["sequence_id"]] += r["length"]
    padded = sum(0 if n & (n - 1) == 0 else 1024 - n for n in sizes.values())
    assert padded < 0.01 * sum(sizes.values())
