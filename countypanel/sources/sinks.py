"""Result tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = "survey_year int, status string, rows long, cols int"


def write_partitioned(df: DataFrame, path: str, *partition: str, mode: str = "overwrite") -> None:
    """Parquet, one folder per value of the partition columns.

    The write is one shuffle-free pass. With dynamic overwrite only the partitions
    present in `df` are replaced, so a re-run of some years leaves the others alone.
    """
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, path: str, *keys: str, buckets: int) -> DataFrame:
    """A table in buckets by `keys`, each sorted by them, with its files below `path`; read again from there.

    Tables of equal bucket numbers and keys join and group by these keys without an exchange. Rows are brought together by bucket
    first, so that a bucket is one file. A key that holds much of the rows makes its bucket as large: bucket panels, not observations.
    """
    (
        df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    )
    return df.sparkSession.table(table)


def export_csv(df: DataFrame, path: str, *partition: str) -> None:
    """CSV export with a header; Parquet stays the working format."""
    writer = df.write.mode("overwrite").option("header", True)
    if partition:
        writer = writer.partitionBy(*partition)
    writer.csv(path)


def state_of_file(name):
    """State label in the last dotted part of a file name such as "x.data.7.Alabama"."""
    return F.element_at(F.split(name, r"\."), -1)


def append_run_log(summary: DataFrame, path: str) -> None:
    """Add run results to the log; earlier entries stay."""
    summary.select("survey_year", "status", "rows", "cols").write.mode("append").json(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).json(path)
