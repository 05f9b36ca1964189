from collections import Counter

import pytest
from odd import ODD_TEXTS, documents

from stratamill.llm.quality import Rule, quality


def expected(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by plain loops."""
    text = text or ""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if any(c not in " \t\n\x0b\x0c\r" for c in line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


TEXTS = [
    *ODD_TEXTS,
    (20, "a b c a b c"),
    (21, "a a a a"),
    (22, "x\nx\n \n \nx y"),
    (23, "#1 *two* <b>|</b>\n#1 *two* <b>|</b>"),
    (24, " ".join(["the cat sat on a mat and"] * 9)),
    (25, "the quick one of them is here and it was " + " ".join(f"word{i} to" for i in range(60))),
]


def test_measures_equal_plain_loops(spark):
    rows = quality(documents(spark, TEXTS)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = Counter((r["doc_id"], *[r[n] for n in names]) for r in rows)
    assert got == Counter((key, *expected(text)) for key, text, *_ in TEXTS)
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["failed_rules"] == "")
    assert {r["doc_id"] for r in rows if r["kept"]} == {5, 25}


def test_rules_name_what_failed(spark):
    text = "<b> " * 30 + " ".join(f"odd{i}" for i in range(60))
    rules = (Rule("few_symbols", "n_symbols", "n_words", high=0.1), Rule("stops", "n_stop_words", "n_words", low=0.5))
    assert quality(documents(spark, [(1, text)]), rules=rules).first()["failed_rules"] == "few_symbols,stops"


def test_empty_table_and_no_python(spark):
    judged = quality(documents(spark, []))
    assert judged.count() == 0
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_kept_columns_must_not_clash(spark):
    with pytest.raises(ValueError):
        quality(documents(spark, []), keep=("doc_id", "kept"))
