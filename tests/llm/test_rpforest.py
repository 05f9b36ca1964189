import math

import numpy as np
import pytest

from stratamill.llm import rpforest
from stratamill.llm.rpforest import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node string, leaf int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def clustered():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(700):
        centre = np.random.default_rng(i % 60).standard_normal(32)
        noisy = centre + rng.standard_normal(32) * rng.choice([0.01, 0.1, 0.2, 2.0])
        rows.append((i, [float(x) for x in noisy.astype(np.float32)], int(rng.integers(0, 3)) if i % 9 else 0))
    rows += [(1000 + i, rows[i * 7][1], rows[i * 7][2]) for i in range(40)]
    return rows


def brute(rows, least):
    usable = {k: (np.array(v, float), label) for k, v, label in rows}
    root, links = {k: k for k in usable}, dict.fromkeys(usable, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in usable:
        for b in usable:
            (x, p), (y, q) = usable[a], usable[b]
            if a != b and p == q and x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                links[a] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: (links[k], find(k), find(k) == k) for k in usable}


@pytest.mark.parametrize("block", [40, 2048])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(rpforest, "LEAF", 60)
    monkeypatch.setattr(rpforest, "BLOCK", block)
    rows = clustered()
    found = near_vectors(frame(spark, rows)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == brute(rows, 0.98)
    assert len(found) == len(rows)


def test_odd_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    same = [1.0, 2.0]
    rows = [
        (1, None, 0),
        (2, [], 0),
        (3, [0.0, -0.0], 0),
        (4, [nan, 1.0], 0),
        (5, [inf, 1.0], 0),
        (6, [None, 1.0], 0),
        (7, same, None),
        (8, same, None),
        (9, same, 0),
        (10, [1.0, 2.0, 0.0], 0),
        (11, [1e-30, 2e-30], 0),
        (12, [3e30, 6e30], 0),
        (None, same, 0),
        (13, same, 1),
        (13, same, 1),
    ]
    found = near_vectors(frame(spark, rows)).collect()
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in found)
    alone = [(k, 0, k, True) for k in (1, 2, 3, 4, 5, 6, 7, 8, 10)]
    linked = [(9, 2, 9, True), (11, 2, 9, False), (12, 2, 9, False), (13, 1, 13, True), (13, 1, 13, True)]
    assert got == sorted([(-1, 0, -1, True), *alone, *linked])
    assert near_vectors(frame(spark, [])).count() == 0


def test_splits_part_no_pair_that_is_closer_than_twice_the_spill():
    rng = np.random.default_rng(1)
    units = rng.standard_normal((3000, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    tree = rpforest.Tree(8, 6, units[:2000], 1)
    rows, nodes = tree.leaves(units)
    assert set(rows.tolist()) == set(range(len(units)))
    leaves = {}
    for row, node in zip(rows.tolist(), nodes.tolist(), strict=True):
        leaves.setdefault(row, set()).add(node)
    gaps = units @ tree.directions.T
    for a in range(200):
        close = np.abs(gaps[a] - gaps).max(axis=1) <= 2 * rpforest.SPILL
        for b in np.flatnonzero(close).tolist():
            assert leaves[a] & leaves[b]
    assert max(np.unique(nodes, return_counts=True)[1]) < len(units) / 3
