import random

import duckdb
from odd import ODD_TEXTS, documents

from stratamill.llm.licenses import (
    PHRASES,
    SHORT,
    TEMPLATES,
    least_common,
    license_scan,
    template_words,
    window_lengths,
    words_of as notice_words,
)
from stratamill.llm.sql import LICENSES

LINES = [
    "Licensed under the Apache License, Version 2.0.",
    "### licensed *** UNDER the: apache license / version 2",
    "under the license",
    "CC BY cc-by all rights reserved, All Rights\nReserved! general PUBLIC license",
    "This work is licensed under the GNU General Public License, version 3.",
    "Permission is hereby granted free of charge to any person obtaining a copy of this",
    "ccé by ccby cc\u212aby",
    "Copyright 2020. Released under the MIT License.\n\n\nAll rights reserved.",
]

WRAPPED = {
    "bsd": "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided",
    "mpl-2.0": "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy",
    "gpl": "it under the\nyou can redistribute it and/or modify\nit under the terms of the GNU General\nPublic License as",
    "mit": "This is released under the terms of the MIT License.",
    "apache-2.0": "x\n" * 3000 + "Licensed under the terms of the Apache License,\nVersion 2.0" + "\ny" * 3000,
    "isc": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby\n"
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "": "The album was released under license in 1999. He reserved all seats and sold the rights."
    " The film was released under the new license in May. They reserved all rights of way.",
}


def words_of(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text)
    return "".join(c if (c.isascii() and c.isalnum()) or ord(c) > 127 else " " for c in lowered).split(" ")


def expected(text):
    words = [w for w in words_of(text or "") if w]
    places = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    scores, labels = [0.0], set()
    for label, notice in TEMPLATES:
        wanted = template_words(notice)
        near, far = window_lengths(len(notice_words(notice)))

        def most(length):
            return max(len(wanted & set(words[i : i + length])) for i in range(max(len(words) - length + 1, 1)))

        common = len(wanted) if most(far) == len(wanted) else most(near)
        if common >= least_common(len(wanted)):
            scores.append(common / len(wanted))
            labels.add(label)
    base = {label for _, label in places}
    at = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(at, default=None),
        max(at, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | labels)),
        max(scores + [1.0] * bool(places)),
    )


def test_equals_plain_loops(spark):
    rows = [*ODD_TEXTS, *[(100 + i, line) for i, line in enumerate(LINES)], (200, "\n".join(LINES))]
    texts = {key: text for key, text, *_ in rows}
    found = license_scan(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[1:] == expected(texts[r["doc_id"]]), texts[r["doc_id"]][:80]
    assert license_scan(documents(spark, [])).count() == 0


def test_windows_equal_plain_loops_whatever_words_are_rare(spark):
    """Notices with words left out, doubled, moved and broken into lines, among filler that makes other words frequent."""
    rng = random.Random(8)
    texts = list(WRAPPED.values())
    for _ in range(120):
        words = []
        for _ in range(rng.randint(1, 3)):
            notice = rng.choice(TEMPLATES)[1].split()
            words += [w for w in notice if rng.random() < 0.93 for _ in range(1 + (rng.random() < 0.05))]
            words += rng.choices("the of software license notice copies granted under x y z".split(), k=rng.randint(0, 40))
        at = rng.randrange(len(words))
        texts.append("\n".join(" ".join(part) for part in (words[:at], words[at:])))
    found = license_scan(documents(spark, list(enumerate(texts)))).collect()
    assert len(found) == len(texts)
    for r in found:
        assert tuple(r)[1:] == expected(texts[r["doc_id"]]), texts[r["doc_id"]]
    assert len({r["labels"] for r in found}) > 10


def test_sql_reads_windows_too(spark, tmp_path):
    texts = [*WRAPPED.values(), *LINES, "\n".join(LINES), None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = str(tmp_path / "documents")
    frame.coalesce(1).write.parquet(path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    wanted = connection.execute(LICENSES).fetchall()
    assert sorted(map(tuple, license_scan(frame).collect())) == sorted(wanted)


def test_short_notices_need_all_words():
    sizes = {len(template_words(notice)) for _, notice in TEMPLATES}
    assert all(least_common(n) == n for n in sizes if n < SHORT) and any(least_common(n) < n for n in sizes)


def test_stays_in_the_jvm_without_a_shuffle(spark):
    plan = license_scan(documents(spark, [(1, LINES[0])]))._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Arrow", "Exchange", "Join"):
        assert operator not in plan


def test_notices_are_found_in_any_lines_and_only_together(spark):
    texts = list(WRAPPED.values())
    found = {r["doc_id"]: r["labels"] for r in license_scan(documents(spark, list(enumerate(texts)))).collect()}
    assert [found[i] for i in range(len(texts))] == list(WRAPPED)
