"""Quality rules: a threshold table compiled into one projection.

Everything is built from SQL functions of the row's own text, so the operator
neither shuffles nor leaves the JVM, and a hot source or a group of copies costs
nothing extra. Memory is that of one text and its word windows.

Defined cases: a null or empty text has no words and fails; ties and repeated rows
are judged each on their own; an empty table gives an empty result; columns other
than the text are never read, so their names and nulls do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamill.llm.text import NOT_BREAK, single_spaced, word_count

# The base rule's symbols and limits.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that it was for on are as with be at by this from or an have not "
    "de la le les et des en un une du dans que qui pour est sur au par pas avec "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es "
    "el los las y del se por con una para su al lo como más o pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; passes where the denominator is 0."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None

    def failed(self) -> Column:
        ratio = F.try_divide(F.col(self.numerator).cast("double"), F.col(self.denominator).cast("double"))
        below = ratio < self.low if self.low is not None else F.lit(False)
        above = ratio > self.high if self.high is not None else F.lit(False)
        return F.coalesce(below | above, F.lit(False))


RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.6),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("open_lines", "n_open_lines", "n_lines", high=0.3),
)

BASE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = (
    *BASE_MEASURES,
    "n_stop_words",
    "n_lines",
    "n_bullet_lines",
    "n_open_lines",
)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda variable is bound, not inlined."""
    return F.transform(F.array(value), use)[0]


def _covered(windows: Column) -> Column:
    """Positions within any window found twice or more; a window spans ``WINDOW`` words.

    Windows are 64-bit hashes, of which none is null; two different windows of one
    text share one with a chance of about 1e-8 at a million words.
    """

    def repeated_starts(ordered: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1)["w"], F.get(ordered, k + 1)["w"]
            return before.eqNullSafe(x["w"]) | after.eqNullSafe(x["w"])

        return F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))

    def span(starts: Column) -> Column:
        def fresh(p: Column, k: Column) -> Column:
            return F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)))

        return F.aggregate(F.transform(starts, fresh), F.lit(0), lambda a, x: a + x)

    placed = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    return _bound(F.sort_array(placed), lambda s: _bound(repeated_starts(s), span))


def text_measures(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``keep`` (renamed nowhere) and the counts named in ``MEASURES``."""
    body = F.coalesce(F.col(text), F.lit(""))
    kept = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    names = [F.col(f"_keep_{i}") for i in range(len(keep))]
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(NOT_BREAK))
    read = df.select(*kept, body.alias("_text"), single_spaced(F.col(text)).alias("_spaced"), lines.alias("_lines"))
    words = F.when(F.col("_spaced") == "", F.array().cast("array<string>")).otherwise(F.split("_spaced", " "))
    read = read.select(*names, "_text", "_spaced", "_lines", words.alias("_words"))
    windows = F.transform(
        F.slice("_words", 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(F.col("_words"), i + k) for k in range(1, WINDOW)]),
    )
    read = read.select(*names, "_text", "_spaced", "_lines", "_words", windows.alias("_windows"))
    has_repeat = F.size(F.array_distinct("_windows")) < F.size("_windows")
    n_words = word_count(F.col("_spaced"))

    def lines_like(pattern: str) -> Column:
        return F.size(F.filter("_lines", lambda line: line.rlike(pattern))).cast("long")

    measured = {
        "n_words": n_words,
        "word_chars": F.when(n_words == 0, F.lit(0)).otherwise(F.length("_spaced") - n_words + 1).cast("long"),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(has_repeat, _covered(F.col("_windows"))).otherwise(F.lit(0)).cast("long"),
        "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_bullet_lines": lines_like(r"^[\x20\x09-\x0D]*[-*•–]"),
        "n_open_lines": lines_like(r"(\.\.\.|…)[\x20\x09-\x0D]*$"),
    }
    out = read.select(*names, *[value.alias(name) for name, value in measured.items()])
    return out.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)], *MEASURES)


def quality(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """Measures and verdicts, one row per row of ``df``: ``keep``, base measures, verdicts, the others.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated
    windows. ``failed_rules``: names of the table's rules that failed,
    comma-joined in table order. ``kept``: neither.
    """
    clash = {*MEASURES, "base_failed", "failed_rules", "kept"} & set(keep)
    if clash:
        raise ValueError(f"columns that the result defines itself: {sorted(clash)}")
    short = F.col("n_words") < MIN_WORDS
    repetitive = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    base_failed = short | repetitive
    names = F.concat_ws(",", *[F.when(rule.failed(), F.lit(rule.name)) for rule in rules])
    judged = text_measures(df, text, keep).withColumns({"base_failed": base_failed, "failed_rules": names})
    kept = ~F.col("base_failed") & (F.col("failed_rules") == "")
    others = [name for name in MEASURES if name not in BASE_MEASURES]
    return judged.select(*keep, *BASE_MEASURES, "base_failed", kept.alias("kept"), "failed_rules", *others)
