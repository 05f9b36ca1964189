import hashlib
import math
import zlib
from collections import defaultdict

import pytest

from stratamill.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, at string, t0 int, level int"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", 1, 2) for row in rows], SCHEMA)


def word_count(text):
    return len([w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w])


def expected(rows):
    """The nodes by plain loops over dictionaries."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {conv: [t for _, t in sorted(turns, key=lambda x: x[0])] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(math.fmod(conv, 20))
        rebuilt[conv] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children, subtree = defaultdict(int), defaultdict(lambda: [0, 0])
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        saving = (len(convs) - 1) * (word_count(node[-1][1]) if node else 0)
        for d in range(len(node) + 1):
            subtree[node[:d]][0] += node not in children
            subtree[node[:d]][1] += saving
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), children.get(node, 0), *subtree[node], digest))
    return sorted(out, key=str)


def result(df, **parameters):
    return sorted(map(tuple, prefix_trie(df, **parameters).collect()), key=str)


MIXED = [
    *[(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c // 7 % 3}") for c in range(60) for t in range(c % 9)],
    *[(200 + c, t, "user", f"long {t}") for c in range(3) for t in range(23 + c)],
    *[(c, t, "user", "one very common conversation" * (t + 1)) for c in range(1000, 1040) for t in range(3)],
    *[(2041, t, "user", f"no first one of the family {t}") for t in range(6)],
    (3000, 0, "user", "family of a short first"),
    *[(c, t, "user", f"moves up {t}") for c in range(3001, 3020) for t in range(c % 6)],
    (4000, None, None, "first"), (4000, 1, "user", None), (4000, 2, None, None), (4001, 5, "", ""),
    (None, 1, "user", "no conversation"), (-40, 0, "user", "negative"), (-41, 0, "user", "negative"),
    (5000, 1, "user", "twice"), (5000, 1, "user", "twice"), (5001, 0, "user", "word " * 50_000),
]


@pytest.mark.parametrize("width, stretch, run_bits", [(8, 4096, 9), (2, 3, 1), (3, 1, 4)])
def test_nodes_equal_plain_loops(spark, width, stretch, run_bits):
    assert result(frame(spark, MIXED), width=width, stretch=stretch, run_bits=run_bits) == expected(MIXED)


def test_only_turnless_conversations(spark):
    # 3 takes three turns of conversation 0, which has none here, and has one of its own.
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 1)
    rows = [(alone, 0, "user", "gone")]
    empty = hashlib.sha256(str(alone).encode()).hexdigest()
    assert result(frame(spark, rows)) == expected(rows) == [(alone, 0, None, 1, 0, 1, 0, empty)]


def test_ties_have_one_order(spark):
    rows = [(c, 1, "user", f"tie {i}") for c in (20, 40) for i in range(5)]
    got = result(frame(spark, rows))
    assert got == result(frame(spark, rows[::-1]).repartition(3))
    assert sum(r[3] for r in got if r[1] == 5) == 2


def test_empty_table(spark):
    assert result(frame(spark, [])) == []


def test_texts_are_not_shuffled(spark):
    plan = prefix_trie(frame(spark, MIXED[:50]))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "text" not in plan
