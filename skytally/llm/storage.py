"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.session import configure
from skytally.sources.workspace import new_folder

#: Rows of one Arrow batch between the JVM and Python. A batch is held whole, texts can be long.
ARROW_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return configure(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: later steps don't depend on this one's tasks."""
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, written and read again, with a key of their own, and the key's column."""
    row = "row_key"
    while row in map(str.lower, docs.columns):
        row += "_"
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
