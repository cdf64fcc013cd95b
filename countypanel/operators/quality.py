"""Reports on the data: match rates, key counts, gaps, bad values, run results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import PLACEHOLDER_COUNTY
from ..functions.formats import matched_of_total
from ..functions.missing import ratio, to_number
from .survey import county_codes, with_county_names


def first_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The first few different values of a column, in order; a look at the data."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(n)


def code_counts(raw: DataFrame, by=("survey_year",)) -> DataFrame:
    """Rows per written state and county code, codes cleaned afterwards.

    The reports below need only these counts, so the respondents are read once with a
    map-side aggregate and everything else runs on a few thousand rows.
    """
    counts = raw.groupBy(*by, "_state", "ctycode").agg(F.count("*").alias("rows"))
    return county_codes(counts)


def match_rate(raw: DataFrame, crosswalk: DataFrame, by=("survey_year",)) -> DataFrame:
    """Rows whose county is in the crosswalk, out of those with a county code."""
    named = with_county_names(code_counts(raw, by), crosswalk)
    coded = F.when(F.col("ctycode") != PLACEHOLDER_COUNTY, F.col("rows")).otherwise(0)
    found = F.when(F.col("county_name").isNotNull(), coded).otherwise(0)
    return (
        named.groupBy(*by)
        .agg(F.sum(found).alias("matched"), F.sum(coded).alias("total"))
        .where(F.col("total") > 0)
        .withColumn("match_rate", ratio(F.col("matched"), F.col("total")))
        .withColumn("match_text", matched_of_total(F.col("matched"), F.col("total")))
    )


def key_profile(raw: DataFrame) -> DataFrame:
    """Per state code: rows, distinct county codes, placeholder rows, first and last year."""
    placeholder = F.when(F.col("ctycode") == PLACEHOLDER_COUNTY, F.col("rows")).otherwise(0)
    per_code = code_counts(raw).groupBy("_state", "ctycode").agg(
        F.sum("rows").alias("rows"),
        F.sum(placeholder).alias("placeholder_rows"),
        F.min("survey_year").alias("first_year"),
        F.max("survey_year").alias("last_year"),
    )
    return per_code.groupBy(F.col("_state").alias("state_fips")).agg(
        F.sum("rows").alias("rows"),
        F.count("*").alias("county_codes"),
        F.sum("placeholder_rows").alias("placeholder_rows"),
        F.min("first_year").alias("first_year"),
        F.max("last_year").alias("last_year"),
    )


def map_match_rate(mapped: DataFrame, by=("survey_year",)) -> DataFrame:
    """Features that found their county, out of all."""
    counts = mapped.groupBy(*by).agg(F.count("mhi").alias("matched"), F.count("*").alias("total"))
    return counts.withColumn("match_text", matched_of_total(F.col("matched"), F.col("total")))


def run_summary(
    requested: DataFrame, available: DataFrame, done: DataFrame
) -> DataFrame:
    """Result per requested year: "not_found", "skipped_existing", or "ok" with its size.

    `available` has rows and columns of each year, `done` the years written earlier.
    """
    marked = done.select("survey_year", F.lit(True).alias("written"))
    status = (
        F.when(F.col("found").isNull(), "not_found")
        .when(F.col("written"), "skipped_existing")
        .otherwise("ok")
    )
    sized = F.col("status") == "ok"
    return (
        requested.join(
            available.select("survey_year", F.lit(True).alias("found"), "rows", "cols"),
            "survey_year", "left",
        )
        .join(marked, "survey_year", "left")
        .withColumn("status", status)
        .select(
            "survey_year", "status",
            F.when(sized, F.col("rows")).alias("rows"),
            F.when(sized, F.col("cols")).alias("cols"),
        )
    )


def expected_years(places: DataFrame, first: int, last: int) -> DataFrame:
    """Every place in every year of a closed range."""
    years = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("survey_year")
    return places.distinct().select("*", years)


def empty_partitions(
    states: DataFrame, survey_counts: DataFrame, labor_counts: DataFrame, first: int, last: int
) -> DataFrame:
    """Survey and labour rows of every state and year, marked where a side has none."""
    keys = ["state_name", "survey_year"]
    survey = survey_counts.select(*keys, F.col("rows").alias("survey_rows"))
    labor = labor_counts.select(*keys, F.col("rows").alias("labor_rows"))
    grid = expected_years(states.select("state_name"), first, last)
    filled = grid.join(survey, keys, "left").join(labor, keys, "left").na.fill(
        0, subset=["survey_rows", "labor_rows"]
    )
    no_survey, no_labor = F.col("survey_rows") == 0, F.col("labor_rows") == 0
    return filled.withColumn(
        "status",
        F.when(no_survey & no_labor, "empty")
        .when(no_survey, "no survey rows")
        .when(no_labor, "no labor rows")
        .otherwise("ok"),
    )


def coverage_gaps(crosswalk: DataFrame, panel: DataFrame, first: int, last: int) -> DataFrame:
    """County-years of the range that the panel does not have. Counties by code."""
    counties = crosswalk.select("fips", "state_name", "county_name")
    keys = ["fips", "survey_year"]
    missing = expected_years(counties, first, last).join(panel.select(*keys), keys, "left_anti")
    return missing.select("fips", "state_name", "county_name", "survey_year")


def bad_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: texts present, and those among them that are not numbers."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], columns, "column", "value")
    unreadable = F.col("value").isNotNull() & to_number(F.col("value")).isNull()
    return long.groupBy("column").agg(
        F.count("value").alias("present"), F.count_if(unreadable).alias("bad")
    )
