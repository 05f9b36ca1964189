"""The pipeline against a brute-force version of its stages."""

import random
from collections import Counter, defaultdict

from odd import ODD_TEXTS, documents

import corpus_pipeline
from stratamill.llm.parameters import SOURCE_WEIGHTS

SECRET = "token = 0123456789abcdef0123456789abcdef"


def corpus():
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(500)] + ["the", "of", "and"] * 60
    rows = [(k, t, "en", "src0") for k, t, *_ in ODD_TEXTS]
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(120)]
        rows.append((100 + i, " ".join(words), "en", f"src{i % 4}"))
        if i % 5 == 0:
            rows.append((500 + i, " ".join([*words[:-2], "other", "end"]), "en", "src1"))
        if i % 7 == 0:
            rows.append((700 + i, "  ".join(w.upper() for w in words[:60]) + " " + SECRET, "en", "src9"))
    rows.append((900, " ".join(f"only{i} the" for i in range(40)) + " " + SECRET, "en", None))
    rows.append(rows[-1])
    rows.append((901, "#### $$$$ " * 60, "en", "src1"))
    return rows


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stages(spark):
    rows = corpus()
    docs = documents(spark, rows)
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], "unused"))
    good, unique, clean, mixed, packed = frames[1:]
    for frame in (good, unique, clean, mixed):
        assert frame.columns == docs.columns

    texts = {key: text for key, text, *_ in rows}
    kept = Counter(r["doc_id"] for r in good.collect())
    assert kept[901] == 0 and kept[4] == 0 and kept[None] == 0 and kept[900] == 2
    assert all(kept[100 + i] == 1 for i in range(60))

    left = Counter(r["doc_id"] for r in unique.collect())
    assert set(left.values()) == {1}
    groups = sorted(kept)
    for key in groups:
        similar = [
            k for k in groups if 100 * len(shingles(texts[k]) & shingles(texts[key])) >= 80 * len(shingles(texts[k]) | shingles(texts[key]))
        ]
        assert (key in left) == (key == min(similar))

    shown = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(shown) == set(left)
    for key, text in shown.items():
        assert text == texts[key].replace(SECRET, "[SECRET]")

    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert set(copies) <= set(left) and set(SOURCE_WEIGHTS) >= {"src0", "src1"}

    ids, filled = defaultdict(int), defaultdict(int)
    for r in packed.collect():
        ids[r["doc_id"]] += r["piece"] == 0
        filled[r["sequence_id"]] += r["length"]
        assert len(r["ids"]) == r["length"]
    assert ids == copies and max(filled.values()) <= 2048


def test_run_equals_the_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, sf_dir)
    whole = Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed.collect())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in docs.collect()) == whole


def test_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused")
    assert docs.count() == 0
