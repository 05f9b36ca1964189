import math

import numpy as np
import pytest

from stratamill.llm.hard_negatives import coarser, hard_negatives, summaries

SCHEMA = "vec_id long, embedding array<double>, label int, row string, block int, place string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", 0.5) for row in rows], SCHEMA)


def expected(rows, every):
    usable = []
    for key, vector, label in rows:
        fine = vector is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in vector)
        if key is not None and label is not None and fine:
            usable.append((key, [math.floor(256 * x) for x in vector], label))
    out = []
    for a, (anchor, va, la) in enumerate(usable):
        if anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(va, v, strict=True)), key, label)
            for i, (key, v, label) in enumerate(usable)
            if i != a and len(v) == len(va)
        ]
        for p, positive, _ in sorted(s for s in scored if s[2] == la)[:5]:
            fit = [s for s in scored if s[2] != la and -30 * p <= -100 * s[0] <= -90 * p]
            for rank, (n, negative, _) in enumerate(sorted(fit)[:10], 1):
                out.append((anchor, positive, rank, negative, -p, -n))
    return sorted(out)


def vectors(count, dim, seed, clusters=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return [
        (i, (centres[i % clusters] + rng.normal(size=dim) * 0.7).round(3).tolist(), int(rng.integers(3)))
        for i in range(count)
    ]


ODD = [
    (0, [0.5, 0.25], 1), (0, [0.5, 0.25], 1), (None, [0.5, 0.5], 1), (7, None, 1), (8, [0.5, None], 2),
    (9, [math.nan, 1.0], 2), (10, [math.inf, 1.0], 2), (11, [1.0, 1.0], None), (12, [], 1), (20, [], 1), (13, [], 2),
    (14, [0.25, 0.25], 2), (15, [0.25, 0.25], 2), (16, [0.25, 0.25], 2), (17, [1.0, 2.0, 3.0], 2), (18, [0.0, 0.0], 2),
    (30, [-1.0, -1.0], 3), (31, [1.0, 1.0], 3), (32, [0.3, 0.3], 1), (-10, [0.4, 0.4], 1), (19, [1e308, 1.0], 2),
]


@pytest.mark.parametrize("parameters", [{}, {"anchors_a_block": 7, "shards": 3}, {"anchors_a_block": 1, "shards": 1}])
def test_equals_all_pairs(spark, parameters):
    rows = [*ODD, *[(1000 + i, v, label) for i, v, label in vectors(400, 24, 1)]]
    df = frame(spark, rows).repartition(5)
    got = sorted(map(tuple, hard_negatives(df, anchor_every=10, **parameters).collect()))
    assert got == expected(rows, 10) and len(got) > 500


def test_ties_and_a_hot_group_of_copies(spark):
    copies = [(i, [0.5] * 8, i % 2) for i in range(300)]
    others = [(300 + i, [0.5] * 4 + [0.1 * (i % 5)] * 4, i % 3) for i in range(100)]
    got = sorted(map(tuple, hard_negatives(frame(spark, copies + others), anchor_every=50, shards=2).collect()))
    assert got == expected(copies + others, 50)


def test_large_numbers_are_exact(spark):
    rows = [(i, [1e6 * (i + 4) / 9, 8e5 * (i + 1) / 7 - i, 1e5 + i * i], i % 3) for i in range(40)]
    got = sorted(map(tuple, hard_negatives(frame(spark, rows), anchor_every=10).collect()))
    assert got == expected(rows, 10) and got and max(r[4] for r in got) > 2**53


def test_scores_beyond_a_long_do_not_fail(spark):
    rows = [(i, [1e300, float(i)], i % 2) for i in range(12)]
    got = hard_negatives(frame(spark, rows), anchor_every=10).collect()
    assert all(r["positive_score"] == 2**63 - 1 for r in got)


def test_empty_table(spark):
    assert hard_negatives(frame(spark, [])).count() == 0


@pytest.mark.parametrize("dim", [1, 3, 16, 21, 64])
def test_bounds_hold_and_tighten(dim):
    values = np.floor(np.random.default_rng(dim).normal(size=(30, dim)) * 256)
    exact = values @ values.T
    means, deviations = summaries(values)
    radius = []
    for groups in (1, 4, 16):
        m, d = coarser(means, deviations, dim, groups)
        assert np.all(np.abs(exact - m @ m.T) <= d @ d.T + 1e-6)
        radius.append((d @ d.T).mean())
    assert radius == sorted(radius, reverse=True)
