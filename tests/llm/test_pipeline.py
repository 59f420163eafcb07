"""The pipeline keeps what should stay: stages on a small table, and what they remove."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from skytally.llm import quality


@pytest.fixture(autouse=True)
def few_training_steps(monkeypatch):
    train = quality.Network.trained
    monkeypatch.setattr(quality.Network, "trained", lambda samples, labels, steps: train(samples, labels, 300))


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert after.join(before, columns, "left_anti").count() == 0
        if name == "quality_filter":
            good = labels.filter("quality = 1").join(before, "doc_id")
            lost = good.join(after, "doc_id", "left_anti").count()
            assert lost <= 0.05 * good.count()
        if name == "exact_dedup":
            assert after.select("text").distinct().count() == after.count()
        before = after
    tokens = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert tokens.count() == before.count()
    assert tokens.filter(F.col("n_tokens") == 0).count() == before.filter("trim(text) = ''").count()


def test_nulls_repeated_rows_and_more_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, None, "en", "s", 0), (10**9 + 1, "", None, None, 0)], docs.schema)
    wide = docs.unionByName(odd).withColumn("id", F.lit("x")).withColumn("score", F.lit(1)).withColumn("ids", F.lit(2)).withColumn("quality_score", F.lit(0.0))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, wide, sf_dir)
        assert after.columns == wide.columns, name
        assert after.filter("quality_score = 0 and id = 'x'").count() == after.count() <= wide.count()


def test_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_rows_without_or_with_a_repeated_id_are_judged_by_their_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    text = " ".join(f"word{i}" for i in range(60))
    extra = [(None, text), (None, text), (None, text + " end"), (5, text), (5, "x " + item + " y"), (None, item), (6, text + " once more")]
    odd = spark.createDataFrame([(i, t, "en", f"odd{n}", 1) for n, (i, t) in enumerate(extra)], docs.schema)
    stages = dict(corpus_pipeline.STAGES)
    left = docs.unionByName(odd).repartition(4)
    for name, sources in (("exact_dedup", {"odd3", "odd2", "odd4", "odd5", "odd6"}), ("near_dedup", {"odd3", "odd4"}), ("decontamination", {"odd3"})):
        left = spark.createDataFrame(stages[name](spark, left, sf_dir).collect(), docs.schema)
        assert {r.source for r in left.filter("source like 'odd%'").collect()} == sources, name
