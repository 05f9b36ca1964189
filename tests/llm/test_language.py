import random
import zlib

import numpy as np
from odd import ODD_TEXTS, documents

from stratamill.llm.language import CROPS, EMBEDDING, WINDOW, Network, encoded, identify, training_sample, windows_of

WORDS = {
    "aa": "the thing with other and then that".split(),
    "bb": "der und schön nicht größer auch ein".split(),
    "cc": "été être le château garçon où voilà".split(),
}


def corpus(n=600):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.choice([3, 40, 300]))), lang))
    return rows


def test_held_out_texts_are_recognised(spark):
    rows = corpus()
    found = {r["doc_id"]: r for r in identify(documents(spark, rows)).collect()}
    right = [found[k]["lang_pred"] == lang for k, _, lang in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean(right) > 0.97
    for key, _, _ in rows:
        assert found[key]["held_out"] == (zlib.crc32(str(key).encode()) % 3 == 1)
        assert 0 <= found[key]["score"] <= 1


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(k, t, "wrong" if zlib.crc32(str(k).encode()) % 3 == 1 else lang) for k, t, lang in corpus(200)]
    assert "wrong" not in {r["lang_pred"] for r in identify(documents(spark, rows)).collect()}


def test_the_sample_takes_the_same_number_of_each_language(spark):
    rows = [(k, f"text {k}", "aa" if k % 5 else "bb") for k in range(3000)]
    rows += [(7, "text 7", "aa")] * 900 + [(8, f"other {k}", "bb") for k in range(900)] + [(9, "text 9", "cc")] * 3
    usable = {(t, lang) for k, t, lang in rows if zlib.crc32(str(k).encode()) % 3 != 1}
    for size in (10, 400, 5000):
        sample = training_sample(documents(spark, rows), "doc_id", "text", "lang", size)
        texts = [(piece, lang) for lang, piece in sample[::CROPS]]
        assert set(texts) <= usable and len(set(texts)) == len(texts) == min(size, len(usable))
        held = [sum(lang == x for _, lang in usable) for x in ("aa", "bb", "cc")]
        taken = [sum(lang == x for _, lang in texts) for x in ("aa", "bb", "cc")]
        assert taken[2] == held[2] and (max(taken) - min(taken[:2]) <= 1 or taken == held)


def test_odd_rows(spark):
    rows = [*[(k, t, "aa") for k, t, *_ in ODD_TEXTS], (70, "12 34 !?", "bb"), (71, "text", None)]
    found = identify(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] in (1, 2, 3, 8, 70):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["doc_id"] is None:
            assert r["held_out"] is False
    unlabelled = identify(documents(spark, [(1, "some text"), (2, None)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}
    assert identify(documents(spark, [])).count() == 0


def test_windows_cover_every_byte():
    texts = [encoded(t) for t in ("a", "b" * WINDOW, "c" * (WINDOW + 1), "xyz" * 500)]
    windows, owner, used = windows_of(texts)
    for i, text in enumerate(texts):
        seen = b"".join(w.tobytes()[:u] for w, o, u in zip(windows, owner, used, strict=True) if o == i)
        assert len(seen) >= len(text) and (used > 0).all()
        for k in range(0, len(text) - 3):
            assert any(text[k : k + 4] in w.tobytes() for w, o in zip(windows, owner, strict=True) if o == i)


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(0)
    network = Network.fresh(["x", "y"], rng)
    network.embedding = network.embedding.astype(np.float64)
    network.filters = {w: k.astype(np.float64) for w, k in network.filters.items()}
    windows, target = rng.integers(97, 110, (6, 20)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])

    def loss():
        return -np.log(network.probabilities(windows)[np.arange(6), target]).mean()

    grads = network.gradients(windows, target)
    for p, g in zip(network.parameters(), grads, strict=True):
        flat, at = p.reshape(-1), int(np.abs(g).argmax())
        before, step = flat[at], 1e-3
        flat[at] = before + step
        up = loss()
        flat[at] = before - step
        down = loss()
        flat[at] = before
        assert abs((up - down) / (2 * step) - g.reshape(-1)[at]) < 0.05 * abs(g.reshape(-1)[at]) + 1e-4
    assert network.embedding.shape == (256, EMBEDDING)
