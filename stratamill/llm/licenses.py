"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

Blocks are windows of words over the whole text, whatever its lines; templates are notices
and paragraphs of licenses; both are sets of words. A window about as long as a notice
matches where it holds at least ``CONTAINMENT`` of the notice's words, and a longer one
where it holds all of them, as it must for notices of fewer than ``SHORT`` words: four of
five common words say nothing. The join is that of prefix filtering:

* words are ordered by their frequency over all documents, rarest first, counted in one
  pass that keeps only words of templates (its result is bounded by the template list);
* a window with t of a template's words has one of its first ``size - t + 1``: windows
  are looked at around the places of these words only;
* a window's rarest template word is one of these places, so of the words around a place only
  those that stand behind its own word in the order can count: places with fewer than t
  of them are out (positional filter; what is shorter than t words is out with it, the
  length filter). The windows over the rest are verified.

The template side is a bounded parameter, so the join is evaluated within the row: no
shuffle, no user function, and neither hot sources nor frequent lines gather anywhere.

Defined cases: null and empty texts have no words, no label and score 0; repeated rows
are judged each; empty tables give an empty result; columns other than id and text are
not read. Words of equal frequency are ordered by themselves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The phrases of the base rule.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices and paragraphs as their licenses word them. "All rights reserved" is a phrase above:
# its words in any order are no notice.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "Released under the MIT License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
        " on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License"
        " for more details",
    ),
    (
        "bsd",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
CONTAINMENT = 0.8
SHORT = 10
MAX_TEMPLATE_WORDS = 5000

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced_words(text: Column) -> Column:
    """Lower-cased words with one space between them and at either end.

    Two letters beyond ASCII have lower-case forms in ASCII; another letter stands in for
    them, which changes no word's bounds.
    """
    plain = F.coalesce(text, F.lit(""))
    for odd in ("K", "İ"):
        plain = F.replace(plain, F.lit(odd), F.lit("ı"))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(plain), NOT_WORD, " ")), F.lit(" "))


def template_words(text: str) -> frozenset[str]:
    return frozenset(words_of(text))


def words_of(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def least_common(size: int, share: float = CONTAINMENT) -> int:
    """How many of a template's ``size`` words a window has to hold."""
    # A little less than the product, against its rounding up.
    return size if size < SHORT else max(1, math.ceil(size * share - 1e-9))


def window_lengths(length: int) -> tuple[int, int]:
    """Words of the windows for a notice of ``length`` words.

    One that may lack some of the notice's has room for a comment mark per line, one that
    holds all for further words such as "the terms of".
    """
    return length + length // 8, length + length * 3 // 5


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]  # rarest first
    least: int
    length: int  # of the notice, in words

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.least + 1]

    @property
    def near(self) -> int:
        return window_lengths(self.length)[0]

    @property
    def far(self) -> int:
        return window_lengths(self.length)[1]

    def containment(self, words: Column, anchors: Column) -> Column:
        """Of the best window of a text; null where none matches."""
        size, own = len(self.words), _strings(list(self.words))

        def around(anchor: Column) -> Column:
            start = F.greatest(anchor["at"] - self.far + 1, F.lit(0))
            return F.slice(words, start + 1, anchor["at"] + self.far - start)

        def common(block: Column) -> Column:
            return F.size(F.array_intersect(own, block))

        def best(block: Column, length: int) -> Column:
            starts = F.sequence(F.lit(1), F.greatest(F.size(block) - length + 1, F.lit(1)))
            return F.array_max(F.transform(starts, lambda i: common(F.slice(block, i, length))))

        def found(block: Column) -> Column:
            whole = F.when(common(block) == size, best(block, self.far) == size)
            return F.when(whole, F.lit(size)).otherwise(best(block, self.near))

        def hopeful(anchor: Column) -> Column:
            place = F.array_position(own, anchor["word"]).cast("int")
            behind = F.slice(own, F.greatest(place, F.lit(1)), F.lit(size))
            return F.when(place.between(1, len(self.prefix)), F.size(F.array_intersect(behind, around(anchor))) >= self.least)

        blocks = F.transform(F.filter(anchors, hopeful), around)
        most = F.array_max(F.filter(F.transform(blocks, found), lambda n: n >= self.least))
        return most.cast("double") / F.lit(float(size))


def ordered_templates(
    df: DataFrame, text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, share: float = CONTAINMENT
) -> list[Template]:
    """The templates, their words in the order of their frequency over the documents of ``df``."""
    sets = [(label, template_words(notice), len(words_of(notice))) for label, notice in templates]
    vocabulary = sorted(frozenset().union(*[words for _, words, _ in sets]))
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"more than {MAX_TEMPLATE_WORDS} words in the templates")
    words = F.array_intersect(F.split(spaced_words(F.col(text)), " "), _strings(vocabulary))
    counted = df.select(F.explode(words).alias("word")).groupBy("word").count()
    frequency = {row["word"]: row["count"] for row in counted.collect()}
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    found = []
    for label, words, length in sets:
        found.append(Template(label, tuple(w for w in order if w in words), least_common(len(words), share), length))
    return found


def license_scan(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    share: float = CONTAINMENT,
) -> DataFrame:
    """``key``, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    ``score`` is the largest containment of a matching template, 1 with a base phrase, else 0.
    """
    known = ordered_templates(df, text, templates, share)
    rows = df.select(F.col(key).alias("_key"), spaced_words(F.col(text)).alias("_spaced"))
    prefixes = sorted({w for t in known for w in t.prefix})
    phrased = reduce(or_, [F.col("_spaced").contains(f" {phrase} ") for phrase in PHRASES])
    candidate = F.col("_spaced").rlike(f" ({'|'.join(prefixes)}) ")
    rows = rows.select("_key", "_spaced", phrased.alias("_phrased"), candidate.alias("_candidate"))
    some_words = F.when(F.col("_phrased") | F.col("_candidate"), F.split(F.trim("_spaced"), " "))
    rows = rows.select("_key", "_spaced", "_phrased", "_candidate", some_words.alias("_words"))

    def anchor(word: Column, i: Column) -> Column:
        return F.when(word.isin(*prefixes), F.struct(word.alias("word"), i.alias("at")))

    anchors = F.when(F.col("_candidate"), F.array_compact(F.transform("_words", anchor)))
    rows = rows.select("_key", "_spaced", "_phrased", "_words", anchors.alias("_anchors"))
    scored = [_labelled(F.lit(t.label), t.containment(F.col("_words"), F.col("_anchors"))) for t in known]
    found = F.when(F.size("_anchors") > 0, F.array_compact(F.array(*scored)))
    places = F.flatten(F.array(*[_places(phrase, label) for phrase, label in PHRASES.items()]))
    rows = rows.select(
        "_key",
        "_spaced",
        F.coalesce(found, F.array().cast("array<struct<label:string,score:double>>")).alias("_found"),
        F.when(F.col("_phrased"), places)
        .otherwise(F.array().cast("array<struct<label:string,at:int>>"))
        .alias("_places"),
    )
    n_words = F.length("_spaced") - F.length(F.replace("_spaced", F.lit(" "), F.lit(""))) - 1
    base = F.array_sort(F.array_distinct(F.transform("_places", lambda p: p["label"])))
    every = F.array_sort(F.array_union(base, F.transform("_found", lambda m: m["label"])))
    best = F.array_max(F.transform("_found", lambda m: m["score"]))
    return rows.select(
        F.col("_key").alias(key),
        F.when(F.col("_spaced") == "  ", F.lit(0)).otherwise(n_words).cast("long").alias("n_words"),
        F.size("_places").cast("long").alias("n_base"),
        F.array_min(F.transform("_places", lambda p: p["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_places", lambda p: p["at"])).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("_places") > 0, 1.0).otherwise(0.0)).alias("score"),
    )


def _labelled(label: Column, score: Column) -> Column:
    return F.when(score.isNotNull(), F.struct(label.alias("label"), score.alias("score")))


def _places(phrase: str, label: str) -> Column:
    """Where the phrase's words begin in ``_words``."""
    first, *rest = phrase.split()

    def here(word: Column, i: Column) -> Column:
        same = word == first
        for k, other in enumerate(rest, 1):
            same &= F.coalesce(F.get(F.col("_words"), i + k) == other, F.lit(False))
        return F.when(same, F.struct(F.lit(label).alias("label"), i.alias("at")))

    return F.array_compact(F.transform("_words", here))
