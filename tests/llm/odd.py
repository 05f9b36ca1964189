"""Small tables with the odd cases that every operator has to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "kept string, band int, copy string, place string, _row int, length string, host string"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text, ...): what is missing is null; with extra columns of clashing names."""
    full = [(*row, *[None] * (5 - len(row)), "x", 1, "y", "z", 2, "w", "h") for row in rows]
    return spark.createDataFrame(full, f"{DOCUMENTS}, {CLASHING}")


LONG = " ".join(f"word{i} of the" for i in range(40_000))

ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b\x0c "),
    (4, "word"),
    (5, LONG),
    (None, "a text without an id"),
    (6, "the same row twice"),
    (6, "the same row twice"),
    (7, "ÉCOLE ſecond Kelvin K 漢字 \U0001f600 \x00 \xa0nbsp"),
    (8, None),
]
