"""The registered queries of this folder's operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import (
    bpe,
    brown,
    chat,
    decontaminate,
    dedup,
    licenses,
    neardup,
    pii,
    quality,
    resample,
    search,
    toxicity,
    urlfilter,
)
from skytally.llm.storage import prepared, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepared(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _formatted(turns: DataFrame) -> DataFrame:
    def ranges(mask: str) -> Column:
        return F.array_join(
            F.transform(mask, lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ","
        ).alias(mask)

    return chat.preference_pairs(turns).select(
        F.col("pair_id").alias("conv_id"),
        "n_common",
        "prompt",
        "chosen",
        ranges("chosen_mask"),
        "rejected",
        ranges("rejected_mask"),
    )


@_query
def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _formatted(chat.against_partner(table(spark, sf_dir, "conversations")))


@_query
def op1_whole_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _formatted(chat.whole_conversations(table(spark, sf_dir, "conversations")))


#: The rules of the query, host, path and action.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@_query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{action}')" for host, path, action in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, action)")
    judged = urlfilter.filter_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_query
def op3_quality_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, network).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@_query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = dedup.kept_rows(dedup.exact_groups(table(spark, sf_dir, "documents")))
    return groups.select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@_query
def op5_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = brown.train(docs.filter(~brown.held_out(F.col("doc_id"))))
    return brown.score(docs, model).select(
        "doc_id",
        brown.held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


@_query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["phrase"])

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )


@_query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.jaccard_links(table(spark, sf_dir, "documents"))


#: The vocabulary of the query; any file of its kind serves.
VOCABULARY = "word_bpe_49k.json"


@_query
def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = bpe.encode(docs, public_tokenizers.path(VOCABULARY), decoded="decoded")
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op10_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        parts = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(parts, ",")

    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
    )


@_query
def op11_toxicity_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@_query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@_query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
