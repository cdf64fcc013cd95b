"""Land new labour files as they arrive, each once, and stop when none is left.

The same resume behaviour as the batch path (`pending_years`), with the bookkeeping done
by the stream's checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.missing import clean_missing
from ..sources.delimited import DATA_COLUMNS, text_schema
from ..sources.sinks import state_of_file


def checkpoint_folder(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """Folder for a stream's progress inside the cluster's shared checkpoint folder.

    `fallback` serves sessions on one machine that set none, such as tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.startswith("local"):
        base = fallback
    if not base:
        raise ValueError("spark.checkpoint.dir is not set")
    return f"{base.rstrip('/')}/{name}"


def new_labor_files(spark: SparkSession, folder: str, glob: str = "*.data.*") -> DataFrame:
    """Stream over headerless labour files, with the state named by each file."""
    lines = (
        spark.readStream.schema(text_schema(DATA_COLUMNS))
        .option("sep", "\t")
        .option("header", False)
        .option("pathGlobFilter", glob)
        .csv(folder)
    )
    return clean_missing(
        lines.select(*DATA_COLUMNS, state_of_file(F.col("_metadata.file_name")).alias("state"))
    )


def land_labor(
    spark: SparkSession, folder: str, target: str, name: str = "labor_landing",
    fallback: str | None = None,
) -> StreamingQuery:
    """Append all files not landed yet to Parquet by state, then stop.

    The file sink commits whole batches and the checkpoint knows the files taken, so a
    re-run after a lost executor or driver neither skips nor repeats a file.
    """
    return (
        new_labor_files(spark, folder)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint_folder(spark, name, fallback))
        .partitionBy("state")
        .trigger(availableNow=True)
        .start()
    )
