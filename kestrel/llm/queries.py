"""One registered query per corpus operator, with production parameters over the
whole given table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import (
    ann, bpe_codec, decontamination, filter_audit, license_scan, near_dedup, pivots, ranked_search, suffix_dedup, token_counts, toxicity,
    url_filter, warc_audit,
)
from kestrel.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.PAGE_RULES).drop("score")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(table(spark, sf_dir, "documents"))


def op6_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_audit.page_audit(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_decontamination, op3_near_duplicates, op4_url_filter, op5_suffix_dedup, op6_warc_audit, op7_license_scan,
        op8_bpe_codec, op9_toxicity, op10_nearest_neighbours, op11_embedding_near_dedup, op12_ranked_search, op13_filter_audit)
}

ORACLE_SQL: dict[str, str] = {
    "op4_url_filter": url_filter.ORACLE_SQL, "op6_warc_audit": warc_audit.ORACLE_SQL, "op7_license_scan": license_scan.oracle_sql(),
    "op11_embedding_near_dedup": pivots.ORACLE_SQL, "op12_ranked_search": ranked_search.ORACLE_SQL, "op13_filter_audit": filter_audit.ORACLE_SQL,
}
