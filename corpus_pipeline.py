"""The corpus-cleaning pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; the next stage
reads that from Parquet. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe_codec, decontamination, near_dedup, suffix_dedup, toxicity
from kestrel.llm.common import table
from kestrel.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the ordinal model rejects go. Null and empty texts stay, and all others
    that hold none of the model's words and pieces."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays."""
    return near_dedup.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier are cut out of the texts and n_chars follows. A
    document of which nothing is left goes; untouched ones stay as they are."""
    out = suffix_dedup.remove_repeats(docs)
    cut = F.size(F.col(f"`{out.columns[-1]}`")) > 0  # the last column, whatever the documents' own are called
    return out.where(~cut | (F.col("text") != "")) \
        .withColumn("n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))) \
        .select(*(f"`{c}`" for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept text, decoded again; digests of both."""
    return bpe_codec.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: SQL can express neither the fitted model nor the tokenizer: tested against a
#: brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{base}/{k}")
            docs = spark.read.parquet(f"{base}/{k}")
    return docs
