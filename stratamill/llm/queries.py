"""The operators over the driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamill.llm.hard_negatives import hard_negatives
from stratamill.llm.language import identify
from stratamill.llm.licenses import license_scan
from stratamill.llm.minhash import near_duplicates
from stratamill.llm.mixing import mix
from stratamill.llm.online_packing import pack_online
from stratamill.llm.packing import pack
from stratamill.llm.pages import page_texts
from stratamill.llm.parameters import SOURCE_WEIGHTS
from stratamill.llm.prefix_trie import prefix_trie
from stratamill.llm.quality import quality
from stratamill.llm.reputation import url_filter
from stratamill.llm.rpforest import near_vectors
from stratamill.llm.secret_scan import secret_report
from stratamill.llm.tables import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), keep=("doc_id",))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least_cosine=0.98)


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector is given a wrong label, so that there are negatives close by."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = (F.col("label").cast("long") + 1) % 10
    return hard_negatives(vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))))


def op12_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_online(table(spark, sf_dir, "documents"), with_ids=False)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_quality_rules,
        op2_mixing,
        op3_secret_scans,
        op4_language_id,
        op5_html_extraction,
        op6_minhash_near_dedup,
        op7_embedding_near_dedup,
        op8_license_scans,
        op9_packing,
        op10_url_filters,
        op11_hard_negatives,
        op12_online_packing,
        op13_prefix_trie,
    )
}
