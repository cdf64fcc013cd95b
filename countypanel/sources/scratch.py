"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`.

    Only a session on one machine may leave the setting out (tests); it then gets a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: executors share no folder for intermediate tables")
        base = "file://" + tempfile.mkdtemp(prefix="scratch-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str) -> DataFrame:
    """`df` as a Parquet table in `folder`, read again: later steps depend on its files, not on its lineage."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
