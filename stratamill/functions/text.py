"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_lower(text: Column | str) -> Column:
    """Outer spaces off, lower case (tabs and inner spaces stay)."""
    return F.lower(F.trim(text))


def tidy_upper(text: Column | str) -> Column:
    """Outer spaces off, upper case."""
    return F.upper(F.trim(text))
