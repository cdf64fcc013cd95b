"""Labour statistics: long series to county-month and county-year tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import month_of_period
from ..functions.missing import ratio, to_number

COUNTY_AREA = "F"
ANNUAL = 13

# Measure codes and the columns they become.
MEASURES = {
    "05": "employment",
    "06": "unemployment",
    "04": "labor_force",
    "03": "unemployment_rate",
}


def county_areas(area: DataFrame, state_fips: str | None = None) -> DataFrame:
    """Areas that are counties, of one state or of all, with their state code."""
    counties = area.where(
        (F.col("area_type_code") == COUNTY_AREA)
        & F.col("area_code").startswith("CN" + (state_fips or ""))
    )
    return counties.select("area_code", "area_text", F.substring("area_code", 3, 2).alias("state_fips"))


def series_of(series: DataFrame, counties: DataFrame) -> DataFrame:
    """Series that belong to one of the counties; drops a header read as data."""
    return series.join(counties.select("area_code"), "area_code", "left_semi")


def series_places(series: DataFrame, counties: DataFrame) -> DataFrame:
    """Measure and county of each series: some ten thousand rows for a whole country."""
    return series.select("series_id", "area_code", "measure_code").join(counties, "area_code")


def labor_star(data: DataFrame, series: DataFrame, counties: DataFrame) -> DataFrame:
    """Observations with their measure and county.

    Series and areas make one lookup first, cut to the columns needed so that no two
    columns share a name. Spark broadcasts it where it finds it small while running, or
    beforehand if it is a written table.
    """
    return data.drop("footnote_codes").join(series_places(series, counties), "series_id")


def with_time(star: DataFrame) -> DataFrame:
    """Year and month as numbers, the area's text as the county."""
    return star.withColumns({
        "county": F.col("area_text"),
        "year": F.col("year").try_cast("int"),
        "month": month_of_period(F.col("period")),
    }).drop("area_text", "period", "series_id")


def typed(star: DataFrame) -> DataFrame:
    """Observations with year, month and value as numbers; unreadable values become NULL."""
    return with_time(star).withColumn("value", to_number(F.col("value")))


def cell_sums(data: DataFrame) -> DataFrame:
    """Sum and number of the readable values per series, year and period.

    Combined map-side before anything is joined, so a series that holds a large part of
    the data reaches the joins as one row per period.
    """
    value = to_number(F.col("value"))
    return data.groupBy("series_id", "year", "period").agg(
        F.sum(value).alias("total"), F.count(value).alias("values")
    )


def labor_wide(
    data: DataFrame, series: DataFrame, counties: DataFrame, annual_period: str = "keep",
    measures=MEASURES, keys=("fips", "state_fips", "county", "year", "month"),
) -> DataFrame:
    """County-months with one column per measure, the mean where a cell occurs twice.

    A month without any value is left out. The annual average comes as month 13 and is
    kept unless `annual_period` is "drop". `measures` may name further codes.

    Rows with an unreadable year or month lose their values and leave with the empty
    months: a filter on these keys would be moved below the counting and parse the texts
    of every observation. The lookup joins after the sums, when adaptive execution knows
    its real size and need not move the sums again.
    """
    if annual_period not in ("keep", "drop"):
        raise ValueError(f"annual_period is 'keep' or 'drop', not {annual_period!r}")
    cells = cell_sums(data).join(series_places(series, counties), "series_id")
    cells = with_time(cells).withColumn("fips", F.substring("area_code", 3, 5))
    usable = F.col("month") != ANNUAL if annual_period == "drop" else F.lit(True)
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    means = []
    for code, name in measures.items():
        here = usable & (F.col("measure_code") == code)
        total, values = F.sum(F.when(here, F.col("total"))), F.sum(F.when(here, F.col("values")))
        means.append(ratio(total, values).alias(name))
    return cells.groupBy(*keys).agg(*means).dropna(how="all", subset=list(measures.values()))


def labor_yearly(
    months: DataFrame, keys=("fips", "county_name", "survey_year"), measures=MEASURES
) -> DataFrame:
    """Mean, minimum and maximum of each measure per county and year."""
    named = months.withColumnsRenamed({"county": "county_name", "year": "survey_year"})
    summaries = [
        fn(name).alias(f"{name}_{label}")
        for name in measures.values()
        for label, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
    ]
    return named.groupBy(*keys).agg(*summaries)
