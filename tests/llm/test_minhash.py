import random

import pytest
from odd import ODD_TEXTS, documents

from stratamill.llm import minhash
from stratamill.llm.components import components
from stratamill.llm.minhash import near_duplicates


def brute(rows, size, percent):
    """Component by (id, text) of rows with an id."""
    sets = {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        grams = [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
        sets[key, text] = set(grams)
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = [k for k in sets if k[0] is not None]
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k in keys:
        least[find(k)] = min(least.get(find(k), k[0]), k[0])
    return {k: (len(sets[k]), least[find(k)] if k[0] is not None else None) for k in sets}


def corpus():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 120]))]
        for member in range(rng.choice([1, 3, 25])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((family * 100 + member, " ".join(words)))
            if rng.random() < 0.3:
                rows.append((family * 100 + member + 50, "  ".join(w.upper() for w in words)))
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for i in range(40):
        own = [f"own{i}-{k}" for k in range(rng.choice([2, 6, 9, 20, 60]))]
        rows.append((5000 + i, " ".join([*own, *passage] if i % 2 else [*passage, *own])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [2, 5])
@pytest.mark.parametrize("few", [0, 500_000])
def test_equals_brute_force(spark, monkeypatch, size, few):
    monkeypatch.setattr(minhash, "BROADCAST_IDS", few)
    rows = [(k, t) for k, t, *_ in ODD_TEXTS] + [(k + 1000, t) for k, t in corpus()]
    want = brute(rows, size, 80)
    found = near_duplicates(documents(spark, rows), size, 80).collect()
    assert len(found) == len(rows)
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1, r["kept"]) for r in found)
    expected = []
    for key, text in rows:
        n, component = want[key, text]
        expected.append((key or -1, n, component or -1, key is None or key == component))
    assert got == sorted(expected)


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0


def test_long_chains_are_one_component(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    found = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in found} == {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)}
    assert len(found) == 44


def test_long_texts_are_hashed_part_by_part(monkeypatch):
    from stratamill.llm import minhash

    words = " ".join(f"w{i % 97}é" for i in range(5000)).encode()
    whole = minhash.word_hashes(words)
    monkeypatch.setattr(minhash, "CHUNK_BYTES", 64)
    assert (minhash.word_hashes(words) == whole).all() and len(whole) == 5000
    assert len(minhash.word_hashes(b"one")) == 1
