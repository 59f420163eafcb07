"""A corpus from raw documents to tokens, each stage over all that the one before has kept.

A stage takes the session, the documents and the folder of the tables and returns a DataFrame. All but the last
return the columns of ``documents``. Every row is judged by its own text, whether its id is null, its own or repeated.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import bpe, decontaminate, dedup, neardup, quality
from skytally.llm.storage import prepared, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; it learns from labels of these documents."""
    prepared(spark)
    network = quality.train(docs, table(spark, sf_dir, "labels"))
    score = "quality_score"
    while score in map(str.lower, docs.columns):
        score += "_"
    scored = quality.score_quality(docs, network, into=score)
    return scored.filter(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, with the smallest id."""
    prepared(spark)
    return dedup.drop_exact(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies one row stays, with the smallest id."""
    prepared(spark)
    return neardup.drop_near(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no test item."""
    prepared(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids and the text they decode to."""
    prepared(spark)
    encoded = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY), decoded="decoded")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: The stages rest on a trained classifier and a tokenizer file, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each one's result written and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
