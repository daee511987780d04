"""Raw documents to token counts in five stages.

Each stage takes (spark, docs, sf_dir), works on every row that the one before
kept and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's rows as Parquet to the shared
folder and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabsmith.llm import bpe, decontam, pii, quality_crf, simhash
from tabsmith.llm.common import read, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the line field, fitted on ``labels``, predicts to be of quality 0."""
    model = quality_crf.train(docs, read(spark, sf_dir, "labels"))
    return quality_crf.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each SimHash component."""
    return simhash.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of ``benchmark``."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data in ``text`` by its kind."""
    return pii.redact_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of what they decode to, per document."""
    return bpe.round_trip(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN, latin_pattern=bpe.LATIN_SPLIT).drop("text")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("tokens", tokens)]

#: A trained field, components and merges are no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
