"""Session settings the package relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results or the handling of hot keys. All can be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, even where that costs one more shuffle later on.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that writes few partitions keeps them open side by side instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings for the time of a block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and the benchmark; on a cluster use ``spark-submit`` and ``configure``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skytally")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skytally-"))
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
