"""Labour figures that are issued again: the latest issue of each figure, kept up as files land.

A figure is a series, year and period. The stream's state holds for each the latest issue and its value, so a file that
comes late, or twice, changes nothing that a later issue has said. Each batch leaves the figures that it touched as a table of its own; a batch that is run
again replaces its table, and one whose write broke off does not count.

Defined results: of two values of one issue the larger text stays, whatever the order of files; a value withdrawn (NULL) by a later issue is
NULL; rows without a series, year or period are left out, as are files whose path names no issue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.missing import clean_missing
from ..sources.delimited import DATA_COLUMNS, text_schema
from .counts import whole_batches

FIGURE = ("series_id", "year", "period")
SAID = ("value", "footnote_codes")
ISSUE_IN_PATH = r"issue[=_-]?([0-9]+)"
LANDED = "series_id string, year string, period string, issue long, value string, footnote_codes string"


def issued_figures(spark: SparkSession, folder: str, pattern: str = ISSUE_IN_PATH, sep: str = "\t", files_per_batch: int = 1_000) -> DataFrame:
    """Stream over headerless labour files with the number of the issue that their path names."""
    lines = (
        spark.readStream.schema(text_schema(DATA_COLUMNS)).option("sep", sep).option("header", False)
        .option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    )
    number = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("long")
    return clean_missing(lines.select(*DATA_COLUMNS, number.alias("issue"))).where(F.col("issue").isNotNull())


def latest(figures: DataFrame) -> DataFrame:
    """One row for each figure: its latest issue and what that says."""
    whole = figures.dropna(subset=list(FIGURE))
    said = F.max(F.struct("issue", *SAID)).alias("said")
    return whole.groupBy(*FIGURE).agg(said).select(*FIGURE, "said.issue", *[f"said.{c}" for c in SAID])


def keep_latest(figures: DataFrame, target: str, progress: str) -> StreamingQuery:
    """Take in all of a stream of issued figures that has not been seen yet, then stop. `progress` is its checkpoint."""
    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch-{number:012d}")

    return (
        latest(figures).writeStream.outputMode("update").foreachBatch(land)
        .option("checkpointLocation", progress).trigger(availableNow=True).start()
    )


def latest_figures(spark: SparkSession, target: str) -> DataFrame:
    """The latest issue of every figure landed so far, in the columns of labour files and `issue`."""
    folders = whole_batches(spark, target)
    landed = spark.read.schema(LANDED).parquet(*folders) if folders else spark.createDataFrame([], LANDED)
    return latest(landed).select(*DATA_COLUMNS, "issue")
