"""End-to-end jobs from landed files to the merged panel.

Each step reads tables and writes a table, so a later step neither repeats an earlier
one nor depends on its executors still being there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import codebook, labor, panel, quality, shares, survey
from ..operators.geography import county_crosswalk
from ..sources import sinks, yearly
from ..sources.delimited import (
    DATA_COLUMNS, SERIES_COLUMNS, read_geocodes, read_with_header, read_without_header,
)

YEAR_ROW = "survey_year int"


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def build_crosswalk(spark: SparkSession, geocodes: str, target: str) -> DataFrame:
    """County crosswalk from a geocode export, written as a table."""
    county_crosswalk(read_geocodes(spark, geocodes)).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def landed_years(spark: SparkSession, log: str) -> DataFrame:
    """Years that were landed in whole, from the run log alone.

    The log is written after the commit of the years, so a year whose write broke off is not in it.
    """
    if not _exists(spark, log):
        return spark.createDataFrame([], YEAR_ROW)
    return sinks.read_run_log(spark, log).where("status = 'ok'").select("survey_year").distinct()


def land_survey(
    spark: SparkSession, folder: str, target: str, log: str, years: list[int],
    fips: bool = True,
) -> DataFrame:
    """Land the yearly survey files that are not landed yet; returns the run summary.

    The driver handles one entry per requested year: its path, or that it is missing.
    All pending years are written by one job, each in place of what its partition may
    hold from a broken run. Only these years are counted, each with its own columns.
    """
    requested = spark.createDataFrame([(int(y),) for y in years], YEAR_ROW)
    files = yearly.resolve_years(requested, yearly.discover_files(spark, folder))
    done = {r[0] for r in landed_years(spark, log).collect()}
    found = {r["survey_year"]: r["path"] for r in files.collect() if r["path"]}
    pending = {year: path for year, path in found.items() if year not in done}
    widths = {}
    if pending:
        tables = {year: read_with_header(spark, path) for year, path in sorted(pending.items())}
        widths = {year: len(table.columns) for year, table in tables.items()}
        raw = yearly.stack_years(tables)
        rows = survey.normalise(raw) if fips else survey.lower_names(raw)
        sinks.write_partitioned(rows.drop("year"), target, "survey_year")
        landed = spark.read.parquet(target).where(F.col("survey_year").isin(list(pending)))
        sizes = landed.groupBy("survey_year").agg(F.count("*").alias("rows"))
    else:
        sizes = spark.createDataFrame([], "survey_year int, rows long")
    available = spark.createDataFrame([(y, widths.get(y)) for y in found], "survey_year int, cols int")
    written = spark.createDataFrame([(y,) for y in done], YEAR_ROW)
    summary = quality.run_summary(requested, available.join(sizes, "survey_year", "left"), written)
    # Written first: the summary must not count again, and the log decides what is done.
    rows = [tuple(r) for r in summary.collect()]
    summary = spark.createDataFrame(rows, sinks.RUN_LOG_SCHEMA)
    sinks.append_run_log(summary, log)
    return summary


def survey_tables(spark: SparkSession, landed: str, crosswalk: DataFrame, target: str) -> None:
    """The four survey tables by year, in two passes over the survey.

    The core tables hold a part of the expanded tables' columns and are taken from these.
    """
    rows = survey.prepare(yearly.read_landed(spark, landed), crosswalk)
    for subject in ("socioeconomics", "health"):
        expanded = f"{target}/{subject}_expanded"
        sinks.write_partitioned(survey.survey_table(rows, f"{subject}_expanded"), expanded, "survey_year")
        core = survey.survey_table(spark.read.parquet(expanded), f"{subject}_core")
        sinks.write_partitioned(core, f"{target}/{subject}_core", "survey_year")


def labor_tables(
    spark: SparkSession, data: str, series: str, area: str, target: str,
    annual_period: str = "keep", form: str = "text",
) -> None:
    """County-month table by state, and the yearly summary.

    `data` is a folder of headerless text files, or with `form="parquet"` a landed table. Data
    without any observation of a county's series stop the job: they are of another form or place.
    """
    counties = labor.county_areas(read_with_header(spark, area, sep="\t"))
    known = labor.series_of(read_without_header(spark, series, SERIES_COLUMNS), counties)
    if form == "text":
        facts = read_without_header(spark, data, DATA_COLUMNS)
    elif form == "parquet":
        facts = spark.read.parquet(data).select(*DATA_COLUMNS)
    else:
        raise ValueError(f"form is 'text' or 'parquet', not {form!r}")
    # The lookup as a table, so that Spark knows its bytes when it plans the join.
    lookup = f"{target}/series"
    known.write.mode("overwrite").parquet(lookup)
    months = labor.labor_wide(facts, spark.read.schema(known.schema).parquet(lookup), counties, annual_period)
    sinks.write_partitioned(months, f"{target}/months", "state_fips")
    landed = spark.read.schema(months_schema()).parquet(f"{target}/months")
    if landed.isEmpty():
        raise ValueError(f"no observation in {data} belongs to a series of the counties")
    labor.labor_yearly(landed).write.mode("overwrite").parquet(f"{target}/yearly")


def months_schema() -> T.StructType:
    """Schema of the county-month table; the state code must not be read as a number."""
    measures = [T.StructField(name, T.DoubleType()) for name in labor.MEASURES.values()]
    return T.StructType([
        T.StructField("fips", T.StringType()),
        T.StructField("state_fips", T.StringType()),
        T.StructField("county", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        *measures,
    ])


def share_table(
    spark: SparkSession, health: str, target: str, variables=None, first: int | None = None,
    last: int | None = None, state: tuple[str, int] | None = None, style: str = "usps",
) -> DataFrame:
    """Shares of the categorical answers from a written survey table, as a long table.

    All years unless a range is given. Counted under the names as stored; the display key
    is made on the counts.
    """
    rows = survey.in_years(spark.read.parquet(health), first, last)
    if state:
        rows = survey.in_state(rows, *state)
    asked = survey.present(rows, variables or codebook.CATEGORICAL)
    counts = shares.answer_counts(rows, asked)
    long = shares.shares_of_counts(survey.with_display_key(counts, style))
    sinks.write_partitioned(long, target, "survey_year")
    return spark.read.schema(share_schema()).parquet(target)


def share_schema() -> T.StructType:
    """Schema of the long share table, as codes must not be read as numbers."""
    counts = [T.StructField(name, T.LongType() if name == "unweighted_count" else T.DoubleType()) for name in shares.MEASURES]
    return T.StructType([
        *[T.StructField(key, T.IntegerType() if key == "survey_year" else T.StringType()) for key in shares.KEYS],
        T.StructField("variable", T.StringType()),
        T.StructField("category", T.StringType()),
        *counts,
    ])


def panel_table(spark: SparkSession, shares_path: str, yearly_path: str, target: str) -> DataFrame:
    """Wide shares, one column for every answer there is, joined to the yearly labour summary."""
    long = spark.read.schema(share_schema()).parquet(shares_path)
    wide = shares.share_wide(long, columns=shares.answer_columns(long))
    merged = panel.merge_panel(wide, spark.read.parquet(yearly_path))
    # Column names carry answer labels with blanks, which Parquet keeps as they are.
    merged.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def clustered_panel(spark: SparkSession, shares_path: str, yearly_path: str, target: str, name: str, buckets: int) -> DataFrame:
    """The panel from tables in buckets by county and year: `name`_shares, `name`_yearly and `name`_panel, files below `target`.

    Each side is shuffled once, when it is written; the join, and later joins and summaries by county and year, need no exchange.
    """
    long = spark.read.schema(share_schema()).parquet(shares_path)
    wide = shares.share_wide(long, columns=shares.answer_columns(long))
    left = sinks.write_bucketed(wide, f"{name}_shares", f"{target}/shares", *panel.COUNTY_YEAR, buckets=buckets)
    right = sinks.write_bucketed(
        spark.read.parquet(yearly_path), f"{name}_yearly", f"{target}/yearly", *panel.COUNTY_YEAR, buckets=buckets)
    return sinks.write_bucketed(panel.merge_panel(left, right), f"{name}_panel", f"{target}/panel", *panel.COUNTY_YEAR, buckets=buckets)
