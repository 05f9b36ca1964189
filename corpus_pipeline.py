"""From raw documents to packed training sequences, in stages over the ``documents`` table.

Every stage takes documents with any further columns, and all but the last return the
columns they got. Nulls, empty tables and repeated rows are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.llm.minhash import near_duplicates
from stratamill.llm.mixing import mix
from stratamill.llm.packing import pack
from stratamill.llm.parameters import SOURCE_WEIGHTS
from stratamill.llm.quality import quality
from stratamill.llm.secret_scan import redacted
from stratamill.llm.tables import table
from stratamill.sinks.written import written_once


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    The optimizer would push a plain condition on the verdict below the projections that
    compute it, and evaluate their parts over and over; past a value of the running task
    it pushes nothing.
    """
    rows = docs.select("text", F.struct(*docs.columns).alias("_row"))
    judged = quality(rows, keep=("_row",)).select("_row", "kept", F.spark_partition_id().alias("_task"))
    return judged.where("kept and _task >= 0").select("_row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more).

    Rows without a doc_id are kept. Rows that repeat an id and its text become one.
    """
    labels = near_duplicates(docs, shingle_words=5, percent=80)
    kept = labels.where("kept and doc_id is not null").select(
        F.col("doc_id").alias("_id"), F.col("text_mark").alias("_mark")
    )
    known = docs.where("doc_id is not null").select(F.struct(*docs.columns).alias("_row"))
    known = known.select("_row", F.col("_row.doc_id").alias("_id"), F.xxhash64("_row.text").alias("_mark"))
    # One exchange by id serves the join and the folding of repeated rows behind it.
    unique = known.repartition("_id").join(kept.repartition("_id"), ["_id", "_mark"], "left_semi")
    unique = unique.dropDuplicates(["_id", "_mark"]).select("_row.*")
    return unique.unionByName(docs.where("doc_id is null"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by chance, so that sources have their target weights, in random order."""
    return mix(docs, SOURCE_WEIGHTS).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, and each piece's place in a training sequence."""
    return pack(docs)


STAGES = [
    ("quality rules", keep_good),
    ("MinHash near-dedup", drop_copies),
    ("secret scans", hide_secrets),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Decoding and tokenizing are beyond SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each reading what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
