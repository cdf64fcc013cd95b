"""Delimited text files, always read as text and typed later by projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import clean_missing

# Column names of the labour files, which carry no usable header.
SERIES_COLUMNS = [
    "series_id", "area_type_code", "area_code", "measure_code", "seasonal", "srd_code",
    "series_title", "footnote_codes", "begin_year", "begin_period", "end_year", "end_period",
]
DATA_COLUMNS = ["series_id", "year", "period", "value", "footnote_codes"]

GEOCODE_COLUMNS = ["level", "state_fips", "county_fips", "area_name"]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_with_header(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    """All columns as text under the names of the header line; missing texts become NULL.

    Every file under `path` must have the same header: Spark matches the columns of a
    multi-file read by position. `read_years` handles files that differ.
    """
    return clean_missing(spark.read.option("header", True).option("sep", sep).csv(path))


def read_without_header(
    spark: SparkSession, path, columns: list[str], sep: str = "\t"
) -> DataFrame:
    """All columns as text under given names.

    A header line, if there is one, arrives as a data row. The joins on area and
    series codes drop it.
    """
    raw = spark.read.option("header", False).option("sep", sep).schema(text_schema(columns))
    return clean_missing(raw.csv(path))


def geocode_rows(raw: DataFrame) -> DataFrame:
    """Data rows of a geocode table: those with a three-digit summary level.

    Drops the preamble lines and the header by content, so it does not depend on how
    the file was split.
    """
    return raw.where(F.col("level").rlike("^[0-9]{3}$"))


def read_geocodes(spark: SparkSession, path, extra: tuple[str, ...] = ()) -> DataFrame:
    """Geocode export (level, state, county, further codes, name) without its preamble."""
    columns = [*GEOCODE_COLUMNS[:3], *extra, GEOCODE_COLUMNS[3]]
    return geocode_rows(read_without_header(spark, path, columns, sep=",")).select(*GEOCODE_COLUMNS)
