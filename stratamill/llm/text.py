"""Word splitting that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters between words, as Java and RE2 patterns read them.
BREAKS = r"[\x20\x09-\x0D]+"
NOT_BREAK = r"[^\x20\x09-\x0D]"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def single_spaced(text: Column) -> Column:
    """Words joined by one space each; empty for a null text or one without words.

    Plain replacements do the most; the pattern runs only where breaks adjoin.
    """
    spaced = F.coalesce(text, F.lit(""))
    for other in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(other), F.lit(" "))
    return F.trim(F.when(spaced.contains("  "), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced))


def word_count(spaced: Column) -> Column:
    """Words of a ``single_spaced`` text, as long."""
    gaps = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())
