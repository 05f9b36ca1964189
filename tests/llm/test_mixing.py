import math
from collections import Counter

import pytest
from odd import ODD_TEXTS, documents

from stratamill.llm.mixing import mix


def test_shares_follow_the_weights(spark):
    rows = [(i, "x" * (10 + i % 7), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(6000)]
    found = mix(documents(spark, rows), {"hot": 1.0, "s0": 2.0, "s1": 0.0}, rest=1.0).collect()
    size = Counter()
    for r in found:
        size[r["source"] if r["source"] in ("hot", "s0", "s1") else None] += len(r["text"])
    total = sum(len(t) for _, t, *_ in rows)
    assert size["s1"] == 0
    for group, weight in (("hot", 1), ("s0", 2), (None, 1)):
        assert abs(size[group] / total - weight / 4) < 0.03
    copies = Counter(r["doc_id"] for r in found if r["source"] == "s0")
    rate = 2 / 4 * total / sum(len(t) for _, t, _, s in rows if s == "s0")
    count = sum(s == "s0" for *_, s in rows)
    for k in range(1, 8):
        share = math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        got = sum(n == k for n in copies.values()) / count
        assert abs(got - share) < 5 * math.sqrt(share / count) + 0.002


def test_runs_draw_the_same_copies_in_a_shuffled_order(spark):
    rows = [(i, f"text {i}", "en", "a") for i in range(500)]
    first, again = (mix(documents(spark, rows).repartition(n), {"a": 1.0}, epochs=2.0).collect() for n in (1, 5))
    key = lambda r: (r["doc_id"], r["copy"], r["place"])
    assert Counter(map(key, first)) == Counter(map(key, again))
    assert len({r["place"] for r in first}) == len(first)
    ids = [r["doc_id"] for r in first]
    assert ids != sorted(ids)


def test_odd_rows(spark):
    frame = documents(spark, [(k, t, None, None) for k, t, *_ in ODD_TEXTS])
    found = mix(frame, {"a": 1.0})
    assert found.columns == [c for c in frame.columns if c not in ("copy", "place")] + ["copy", "place"]
    assert set(r["doc_id"] for r in found.collect()) <= {k for k, *_ in ODD_TEXTS}
    assert mix(documents(spark, []), {"a": 1.0}).count() == 0
    empty = mix(documents(spark, [(1, None, None, "a"), (2, "", None, "b")]), {"a": 1.0})
    assert all(r["text"] in (None, "") for r in empty.collect())
    with pytest.raises(ValueError):
        mix(frame, {"a": -1.0})
    with pytest.raises(Exception, match="too small for its weight"):
        mix(documents(spark, [(1, "x", None, "a"), (2, "y" * 200_000, None, "b")]), {"a": 1.0}).collect()


def test_rows_without_an_id_of_their_own_draw_for_themselves(spark):
    rows = [(None, f"text {i:04}", "en", "a") for i in range(600)] + [(1, f"more {i:04}", "en", "a") for i in range(600)]
    rows += [(2, "same text", "en", "a")] * 600 + [(None, None, "en", "a")] * 600 + [(10 + i, "one text.", "en", "a") for i in range(600)]
    found, again = (mix(documents(spark, rows).repartition(n), {"a": 1.0}).collect() for n in (3, 7))
    assert Counter((r["doc_id"], r["text"], r["place"]) for r in found) == Counter((r["doc_id"], r["text"], r["place"]) for r in again)
    assert len({r["place"] for r in found}) == len(found)
    kinds = Counter((r["text"] or "none")[:4] for r in found)
    assert len(kinds) == 5 and all(abs(n - 600) < 5 * math.sqrt(600) for n in kinds.values())
    copies = Counter(Counter(r["text"] for r in found if (r["text"] or "").startswith("text")).values())
    assert copies[1] > 100 and copies[2] > 50
