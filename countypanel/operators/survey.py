"""Survey microdata: normalised columns, county keys, county names, the four tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import PLACEHOLDER_TEXT, digits_code, integer_code, join_codes
from ..functions.names import display_key
from .codebook import KEY_COLUMNS, SURVEY_TABLES, readable_names


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def normalise(df: DataFrame, year: int | None = None) -> DataFrame:
    """Lower-case column names, a `year`, and county codes by the strict reading.

    The code columns appear only where the survey year has their source columns.
    """
    df = lower_names(df)
    if year is not None:
        df = df.withColumn("year", F.lit(int(year)))
    if "_state" in df.columns:
        df = df.withColumn("state_fips", integer_code(F.col("_state"), 2))
    if "_cnty" in df.columns:
        df = df.withColumn("county_fips3", integer_code(F.col("_cnty"), 3))
        if "state_fips" in df.columns:
            df = df.withColumn("fips", join_codes(F.col("state_fips"), F.col("county_fips3")))
    return df


def county_codes(df: DataFrame) -> DataFrame:
    """`_state`, `ctycode` and `fips` by the lenient reading (first run of digits)."""
    return df.withColumns(
        {"_state": digits_code(F.col("_state"), 2), "ctycode": digits_code(F.col("ctycode"), 3)}
    ).withColumn("fips", join_codes(F.col("_state"), F.col("ctycode")))


def known_counties(df: DataFrame) -> DataFrame:
    """Rows with a county; the placeholder code goes, "don't know" codes stay.

    One pattern on the code as written, which is cheaper than cleaning it for the
    comparison; on cleaned codes it decides the same.
    """
    return df.where(~F.coalesce(F.col("ctycode").rlike(PLACEHOLDER_TEXT), F.lit(True)))


def with_county_names(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """State and county name by fips, NULL where the code is not in the crosswalk."""
    return df.join(crosswalk, "fips", "left")


def with_display_key(df: DataFrame, style: str = "usps") -> DataFrame:
    """`county_name` as "County, ST"; NULL for unmatched rows."""
    return df.withColumn("county_name", display_key(F.col("county_name"), F.col("state_name"), style))


def rename_columns(
    df: DataFrame, further: dict[str, str | None] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Raw names to readable ones; columns in `keep` stay as they are."""
    return df.withColumnsRenamed({
        raw: name
        for raw, name in readable_names(further).items()
        if raw not in keep and (raw == name or name not in df.columns)
    })


def present(df: DataFrame, columns: list[str]) -> list[str]:
    """The listed columns the table has, in list order. Reads the schema only."""
    return [c for c in columns if c in df.columns]


def survey_table(df: DataFrame, name: str) -> DataFrame:
    """One of the four survey tables, from a renamed survey; columns a year lacks are left out."""
    columns = [*KEY_COLUMNS.values(), *SURVEY_TABLES[name].values()]
    return df.select(*present(df, columns))


def prepare(raw: DataFrame, crosswalk: DataFrame, further=None) -> DataFrame:
    """Landed survey rows -> keyed, named and renamed rows ready for `survey_table`.

    One narrow stage plus the crosswalk join; the unused columns of the wide survey
    fall away when the table is selected.
    """
    keyed = county_codes(known_counties(raw))
    return rename_columns(with_county_names(keyed, crosswalk), further)


def in_state(df: DataFrame, name: str, code: int) -> DataFrame:
    """Rows of one state by whichever state column the table has, else all rows."""
    if "state_name" in df.columns:
        found = F.lower("state_name").contains(name.lower())
        return df.where(F.coalesce(found, F.lit(False)))
    if "_state" in df.columns:
        return df.where(F.col("_state").try_cast("double") == code)
    return df


def in_years(df: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows of the closed year range, if the table has years; prunes partitions. None is open."""
    if "survey_year" not in df.columns:
        return df
    if first is not None:
        df = df.where(F.col("survey_year") >= first)
    return df if last is None else df.where(F.col("survey_year") <= last)
