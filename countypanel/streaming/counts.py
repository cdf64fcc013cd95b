"""Answer counts that grow with landed files, so that a new year does not count the old ones again.

Counts merge by adding. Each batch of new rows leaves its counts, by codes as written, as a table of its own named by the batch; a
batch that is run again, after a failure or a restart, replaces its table, and one whose write broke off has no
marker of success and does not count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import shares

CODES = ("_state", "ctycode", "survey_year")


def batch_counter(target: str, variables: list[str], weight: str = "final_weight") -> Callable[[DataFrame, int], None]:
    """A handler for `foreachBatch`: writes the counts of a batch below `target`."""
    def count(batch: DataFrame, number: int) -> None:
        shares.answer_counts(batch, variables, CODES, weight).write.mode("overwrite").parquet(f"{target}/batch-{number:012d}")

    return count


def count_landed(rows: DataFrame, target: str, variables: list[str], progress: str, weight: str = "final_weight") -> StreamingQuery:
    """Count all of a stream of survey rows that has not been counted yet, then stop. `progress` is its checkpoint."""
    return (
        rows.writeStream.foreachBatch(batch_counter(target, variables, weight))
        .option("checkpointLocation", progress).trigger(availableNow=True).start()
    )


def whole_batches(spark: SparkSession, target: str) -> list[str]:
    """Folders of the batches whose write was completed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    top = path(target)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(top):
        return []
    folders = [f.getPath() for f in store.listStatus(top) if f.isDirectory()]
    return sorted(f.toString() for f in folders if f.getName().startswith("batch-") and store.exists(path(f, "_SUCCESS")))


def counted(spark: SparkSession, target: str) -> DataFrame | None:
    """The counts of all whole batches, a row for each batch and group; None before the first."""
    folders = whole_batches(spark, target)
    return spark.read.parquet(*folders) if folders else None
