import pytest
from pyspark.sql import functions as F

from skytally.llm import dedup

ROWS = [(3, "a  b"), (1, "a b"), (2, "a\t\nb"), (4, "A b"), (5, None), (6, ""), (7, " "), (7, " "), (8, "a b"), (None, "z"),
        (9, "x" * 300_000), (10, "x" * 299_999 + "y"), (11, "x" * 300_000)]


@pytest.mark.parametrize("weak", [False, True])
def test_groups(spark, weak):
    """The same with a digest that many texts share: contents decide."""
    digest = (lambda text: F.lit(b"same")) if weak else dedup.sha256
    docs = spark.createDataFrame([(*r, "c", 1) for r in ROWS], "doc_id long, text string, content string, n int").repartition(5)
    found = sorted((tuple(r)[:1] + tuple(r)[2:] for r in dedup.exact_groups(docs, digest=digest).collect()), key=repr)
    expected = [(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 4, 1), (5, 5, 2), (6, 5, 2), (7, 7, 2), (7, 7, 2), (8, 8, 1), (9, 9, 2), (10, 10, 1), (11, 9, 2)]
    if not weak:
        expected.append((None, None, 1))
        assert [r for r in found if r[0] is None] == [(None, None, 1)]
    assert [r for r in found if r[0] is not None] == sorted([e for e in expected if e[0] is not None], key=repr)


def test_kept_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(*r, "c") for r in ROWS], "doc_id long, text string, digest string")
    kept = dedup.drop_exact(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 5, 7, 8, 9, 10]
    assert kept.filter("doc_id is null").count() == 1
    assert dedup.drop_exact(docs.limit(0)).count() == 0


def test_one_row_of_each_group_is_kept(spark):
    rows = [*ROWS, (None, "z"), (None, "z"), (None, "a b"), (4, "other"), (4, "A  b")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, kept int").repartition(4)
    found = dedup.kept_rows(dedup.exact_groups(docs)).collect()
    assert len(found) == len(rows) and {r.kept for r in found} == {True, False}
    kept = sorted((r.doc_id or 0) for r in found if r.kept)
    assert kept == [0, 1, 4, 4, 5, 7, 8, 9, 10] or kept == [0, 1, 4, 4, 5, 7, 9, 10]
    stay = dedup.drop_exact(docs)
    assert stay.columns == docs.columns and sorted((r.doc_id or 0) for r in stay.collect()) == kept


def test_a_hot_text_is_few_rows_after_the_first_step(spark):
    docs = spark.range(0, 30_000, 1, 16).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    found = dedup.exact_groups(docs)
    assert found.filter("keep_id = 0 and group_size = 10000").count() == 10_000
    assert found.count() == 30_000
