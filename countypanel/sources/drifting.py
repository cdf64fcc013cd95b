"""Many delimited files whose headers differ, read in one scan.

A read per file needs a branch of the plan and a look at the file for each. Here one scan reads all files by position, and a table of
headers says for each file at which position a column stands. The plan has the same size for two files and for thousands.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .delimited import text_schema
from ..functions.missing import clean_missing
from .scratch import scratch_folder, written
from .yearly import YEAR_IN_NAME

FILE, YEAR = "__file", "survey_year"


def header_lines(spark: SparkSession, paths, pattern: str = YEAR_IN_NAME, glob: str | None = None) -> DataFrame:
    """(__file, survey_year, header): the first line that is not blank of each file whose path carries a year."""
    lines = files_in(spark, glob).text(paths).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block"), "value",
        F.monotonically_increasing_id().alias("line"))
    first = lines.where((F.col("block") == 0) & (F.trim("value") != "")).groupBy(FILE).agg(F.min_by("value", "line").alias("header"))
    year = F.regexp_extract(FILE, pattern, 1)
    return first.where(year != "").select(FILE, year.cast("int").alias(YEAR), "header")


def files_in(spark: SparkSession, glob: str | None):
    """A reader that takes folders as they are: their names give no columns."""
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", glob) if glob else reader


def names_in(header: str, sep: str) -> list[str]:
    """Column names of a header line; a nameless column is called by its position."""
    names = [name or f"_c{i}" for i, name in enumerate(next(csv.reader([header], delimiter=sep)))]
    lower = [name.lower() for name in names]
    twice = sorted({name for name in lower if lower.count(name) > 1})
    if twice:
        raise ValueError(f"a header names columns more than once: {', '.join(twice)}")
    return names


def read_years_at_once(
    spark: SparkSession, paths: str | list[str], sep: str = ",", pattern: str = YEAR_IN_NAME, glob: str | None = None,
) -> DataFrame:
    """The rows of all yearly files below `paths` with a `survey_year` column, columns matched by name, absent ones NULL.

    `pattern` finds the year in a file's path; files without one are left out. All columns are text, missing texts NULL. Names are one if
    they differ in case only, under the spelling of the earliest year. A file without a line that is not blank has no rows; a short row is
    filled up with NULL; cells beyond a file's header are left out. Files that are none raise ValueError, as a table without columns has no meaning.

    Two passes: the headers (text lines of the files' first blocks, one row a file, written as a table), and the scan. What reaches the driver are the
    distinct header lines.
    """
    headers = written(header_lines(spark, paths, pattern, glob), f"{scratch_folder(spark, 'headers')}/files")
    layouts = headers.groupBy("header").agg(F.min(YEAR).alias("first")).orderBy("first", "header").collect()
    if not layouts:
        raise ValueError(f"no file below {paths} has a year in its path and a header")
    places = {r.header: {name.lower(): i for i, name in enumerate(names_in(r.header, sep))} for r in layouts}
    known: dict[str, str] = {}
    for r in layouts:
        for name in names_in(r.header, sep):
            known.setdefault(name.lower(), name)
    if YEAR in known:
        raise ValueError(f"a header names the column {YEAR}, which the file's path gives")
    layout = spark.createDataFrame(
        [(header, [at.get(name, -1) for name in known]) for header, at in places.items()], "header string, places array<int>")
    files = headers.join(layout, "header").select(FILE, YEAR, "places")
    cells = [f"__{i}" for i in range(max(len(at) for at in places.values()))]
    rows = files_in(spark, glob).option("header", True).option("sep", sep).schema(text_schema(cells)).csv(paths)
    rows = clean_missing(rows.select(F.col("_metadata.file_path").alias(FILE), *cells))
    rows = rows.select(FILE, F.array(*cells).alias("cells")).join(files, FILE)
    cell = lambda i: F.when(F.col("places")[i] >= 0, F.get("cells", F.col("places")[i]))
    early = len(places[layouts[0].header])
    out = [cell(i).alias(name) for i, name in enumerate(known.values())]
    return rows.select(*out[:early], YEAR, *out[early:])
