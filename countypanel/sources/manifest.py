"""List of source archives per year, extended block by block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_years(manifest: DataFrame) -> DataFrame:
    """Years listed in more than one block, with how often."""
    counts = manifest.groupBy("year").agg(F.count("*").alias("entries"))
    return counts.where(F.col("entries") > 1)


def latest_entries(manifest: DataFrame) -> DataFrame:
    """The entry that counts for each year: the one loaded last."""
    last = F.max(F.struct("load_order", "url"))
    return (
        manifest.groupBy("year")
        .agg(last.alias("last"))
        .select("year", F.col("last.load_order").alias("load_order"), F.col("last.url").alias("url"))
    )
