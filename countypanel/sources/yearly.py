"""Files that come one per year: find them, read them by name, see what is left to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .delimited import read_with_header

YEAR_IN_NAME = r"_(\d{4})\.csv$"


def with_file_year(files: DataFrame, column: str = "path", pattern: str = YEAR_IN_NAME) -> DataFrame:
    """Files whose name carries a four-digit year in the expected place, with that year.

    The whole year is taken from its own position. A search for the two last digits
    anywhere in the name would find the 20 of every 20xx file.
    """
    year = F.regexp_extract(F.col(column), pattern, 1)
    return files.where(year != "").withColumn("survey_year", year.cast("int"))


def discover_files(
    spark: SparkSession, folder: str, glob: str = "*_[0-9][0-9][0-9][0-9].csv",
    pattern: str = YEAR_IN_NAME,
) -> DataFrame:
    """(path, survey_year) of the yearly files in a folder, sorted by path."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return with_file_year(listing.select("path"), "path", pattern).orderBy("path")


def resolve_years(requested: DataFrame, files: DataFrame) -> DataFrame:
    """One row per requested year: its first file by name, or status "not_found"."""
    first = files.groupBy("survey_year").agg(F.min("path").alias("path"))
    status = F.when(F.col("path").isNull(), "not_found").otherwise("found")
    return requested.join(first, "survey_year", "left").withColumn("status", status)


def pending_years(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """Candidate years that have no result yet."""
    return candidates.join(done.select("survey_year").distinct(), "survey_year", "left_anti")


def stack_by_name(tables: list[DataFrame]) -> DataFrame:
    """All rows of all tables, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def stack_years(tables: dict[int, DataFrame]) -> DataFrame:
    """Tables by year as one table with a `survey_year` column, columns matched by name."""
    return stack_by_name([t.withColumn("survey_year", F.lit(int(year))) for year, t in sorted(tables.items())])


def read_years(spark: SparkSession, path_by_year: dict[int, str], sep: str = ",") -> DataFrame:
    """Yearly files with their own headers as one table with a `survey_year` column.

    Each year is read with its own header, because one read over files with different
    headers would line the columns up by position. Only the header line of each file
    is looked at here; the rows stay in the plan.
    """
    return stack_years({year: read_with_header(spark, path, sep) for year, path in path_by_year.items()})


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Landed Parquet years as one table; columns that only some years have are kept."""
    return spark.read.option("mergeSchema", True).parquet(folder)
