"""Aggregations. Each combines inside the map tasks first, so a hot key shuffles as a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "flight_count") -> DataFrame:
    """Rows per key; a null key is a group of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean per key; null values are left out."""
    return df.groupBy(key).agg(F.avg(value).alias(name))


def rows_at_maximum(df: DataFrame, column: str) -> DataFrame:
    """All rows that hold the greatest value of a column; none where every value is null.

    The maximum is a scalar subquery of the same plan. An unpartitioned window would pull all rows
    into one task instead.
    """
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def newest_by(df: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: the one with the greatest version, equal versions decided by content."""
    rest = [c for c in df.columns if c != key]
    newest = F.max(F.struct(F.col(version).alias("version"), F.struct(*rest).alias("row")))
    return df.groupBy(key).agg(newest.alias("newest")).select(key, "newest.row.*")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by content, so that a join on the key cannot multiply rows."""
    rest = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(key, "kept.*").select(*df.columns)
