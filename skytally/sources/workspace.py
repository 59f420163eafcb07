"""Where intermediate tables of a query go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the checkpoint folder, or else the warehouse.

    A warehouse on the machine's own disk serves only where everything runs on that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.conf.get("spark.sql.warehouse.dir")
    scheme = folder.split(":", 1)[0] if "://" in folder or folder.startswith("file:") else "file"
    master = spark.conf.get("spark.master", "")
    if scheme == "file" and not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder, deleted by Hadoop when the application ends."""
    path = f"{shared_folder(spark).rstrip('/')}/skytally/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)  # only an existing path can be marked for deletion
    files.deleteOnExit(folder)
    return path


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The rows written to the work folder and read again: later steps don't depend on this one's tasks."""
    path = f"{new_folder(df.sparkSession, name)}/data"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
