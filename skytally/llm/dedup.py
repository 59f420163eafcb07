"""Exact duplicates, combined in steps that no frequent text can make uneven.

1. Each task combines equal texts among its own rows.
2. The winners of a digest are spread over salts, one salt for a task, and merged within each salt.
3. The winners of the salts are merged for good.

At every step rows are equal only if their whole contents are equal: the digest chooses the task, the content is
part of the grouping key. A text that fills a third of the table is one row for each task after step 1, and at most
one for each salt after step 2; salts number the square root of the tasks, so neither step has a large group.

A row finds its group by the digest. Where several contents share a digest, rows of those digests are compared by
content once more.

Null counts as empty text; an empty table gives an empty result. Ties go to the smallest id; rows with the same id
and text count separately in the group's size, and one of them stays. Ids may be null: such rows take part, and one of
them stays only if no row of the group has an id. A text is compared whole, however long it is. Other columns of the
table are not looked at, so their names can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.storage import stored


def normalised(text: Column) -> Column:
    """Runs of white space become one blank; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``docs``: id, digest, keep_id (id of the row that stays), group_size."""
    content = docs.select(F.col(id_column).alias("id"), normalised(F.col(text)).alias("content"))
    rows = content.withColumn("digest", digest(F.col("content")))
    tasks = docs.rdd.getNumPartitions()
    salted = rows.withColumn("salt", F.spark_partition_id() % math.ceil(math.sqrt(max(1, tasks))))
    winners = salted.groupBy("digest", "salt", "content").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    groups = winners.groupBy("digest", "content").agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))
    groups = stored(groups.select("digest", "keep_id", "group_size"), "exact-groups")

    shared = groups.groupBy("digest").count().filter("count > 1").select("digest")
    members = rows.select("id", "digest").join(groups, "digest")
    if not shared.isEmpty():
        # Several contents have one digest: there the winner's content decides.
        winner = rows.select(F.col("id").alias("keep_id"), "digest", "content").join(shared, "digest", "left_semi")
        winner = winner.dropDuplicates(["keep_id", "digest", "content"])
        own = rows.join(shared, "digest", "left_semi")
        by_content = (
            winner.groupBy("digest", "content")
            .agg(F.min("keep_id").alias("keep_id"))
            .join(groups, ["digest", "keep_id"])
        )
        compared = own.join(by_content, ["digest", "content"]).select("digest", "id", "keep_id", "group_size")
        members = members.join(shared, "digest", "left_anti").unionByName(compared)
    return members.select(F.col("id").alias(id_column), "digest", "keep_id", "group_size")


def kept_rows(groups: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``exact_groups`` with the column ``kept``: true for one row of each group, false for all others.

    Rows of one task with the same id and text are one row until they are told apart, so an id that repeats in a third
    of the table is a few rows in the window.
    """
    own = [id_column, "digest", "keep_id", "group_size"]
    alike = groups.withColumn("task", F.spark_partition_id()).groupBy(*own, "task").agg(F.count("*").alias("n"))
    first = F.row_number().over(Window.partitionBy("digest", id_column).orderBy("task")) == 1
    chosen = alike.withColumn("chosen", first & F.col(id_column).eqNullSafe(F.col("keep_id")))
    each = chosen.withColumn("place", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return each.select(*own, (F.col("chosen") & (F.col("place") == 1)).alias("kept"))


def drop_exact(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns: the smallest id; of rows with one id any."""
    found = exact_groups(docs, id_column, text)
    kept = found.filter(F.col(id_column).eqNullSafe(F.col("keep_id"))).select(
        F.col(id_column).alias("kept_id"), F.col("digest").alias("kept_digest")
    )
    kept = stored(kept.groupBy("kept_id", "kept_digest").agg(F.count("*").alias("kept_rows")), "kept")
    digest, columns = sha256(normalised(F.col(text))), docs.columns
    keyed = docs.withColumn("kept_digest", digest).withColumn("kept_id", F.col(id_column))

    def of(some: DataFrame) -> DataFrame:
        same = keyed["kept_digest"].eqNullSafe(some["kept_digest"]) & keyed["kept_id"].eqNullSafe(some["kept_id"])
        return keyed.join(some, same, "left_semi")

    repeated = of(kept.filter("kept_rows > 1")).dropDuplicates(["kept_digest", "kept_id"])
    return of(kept.filter("kept_rows = 1")).select(*columns).unionByName(repeated.select(*columns))
