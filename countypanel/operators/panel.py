"""The merged county-year panel and the tables drawn from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import frequency_rate
from ..functions.formats import settled

COUNTY_YEAR = ("fips", "survey_year")
PLACE_TIME = ("county_name", "survey_year")
BY_STATE_YEAR = ("state_name", "survey_year")
UNEMPLOYMENT = "unemployment_rate_mean"
EXCELLENT = "general_health_status_Excellent_w"

# Answers put together, by name of the group.
HEALTH_GROUPS = {
    "above_good": ["Excellent", "Very good"],
    "good": ["Good"],
    "below_good": ["Fair", "Poor"],
}
SMOKING_GROUPS = {
    "current_smoker": ["Every day", "Some days"],
    "never_smoker": ["Not at all"],
}


def merge_panel(shares: DataFrame, labor: DataFrame, on=COUNTY_YEAR) -> DataFrame:
    """County-years that have both survey shares and labour figures, by county code and year.

    County names are no key over several states. `on` takes PLACE_TIME for tables of one state without codes.
    """
    twice = [c for c in labor.columns if c in shares.columns and c not in on]
    return shares.join(labor.drop(*twice), list(on), "inner")


def mean_by_year(panel: DataFrame, columns: list[str], by=BY_STATE_YEAR) -> DataFrame:
    """Mean over counties, each counting once whatever its population."""
    return panel.groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def grouped_answers(
    panel: DataFrame, variable: str, groups: dict[str, list[str]], kind: str, by=BY_STATE_YEAR,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Yearly means of answers put together into groups, and of further columns."""
    sums = {
        group: sum((F.col(f"{variable}_{a}_{kind}") for a in answers[1:]),
                   F.col(f"{variable}_{answers[0]}_{kind}"))
        for group, answers in groups.items()
    }
    return mean_by_year(panel.withColumns(sums), [*groups, *extra], by)


def collapsed_health(panel: DataFrame, by=BY_STATE_YEAR) -> DataFrame:
    return grouped_answers(panel, "general_health_status", HEALTH_GROUPS, "w", by)


def smoking_trend(panel: DataFrame, by=BY_STATE_YEAR) -> DataFrame:
    return grouped_answers(
        panel, "current_smoking_frequency", SMOKING_GROUPS, "uw", by, extra=(UNEMPLOYMENT,)
    )


def frequency_shares(shares: DataFrame, variable: str = "eats_fruit") -> DataFrame:
    """Shares of a frequency-coded variable with the daily rate its code stands for."""
    return shares.where(F.col("variable") == variable).withColumn(
        "daily_rate", frequency_rate(F.col("category"))
    )


def expected_rate(
    shares: DataFrame, labor: DataFrame, variable: str = "eats_fruit",
    percent: str = "weighted_percent", area=("state_name",), on=COUNTY_YEAR,
) -> DataFrame:
    """Expected times per day by year: mean share of each code times its rate, summed.

    Works on the long table, over the county-years that also have labour figures. A code
    nobody gave counts as 0 there, so the mean divides by all these counties and not by
    the rows present. Shares are taken as percent if any yearly mean of the area exceeds 1. A result of 0 means
    nothing was asked and becomes NULL.
    """
    by = [*area, "survey_year"]
    matched = shares.join(labor.select(*on), list(on), "left_semi")
    place = [c for c in on if c not in by]
    rate = frequency_rate(F.col("category"))
    code = F.when((F.col("variable") == variable) & rate.isNotNull(), F.struct("category", F.col(percent).alias("share")))
    # The counties of a state and year with their codes: a few thousand entries, so that one pass both counts and sums.
    years = (
        matched.groupBy(*by, *place).agg(F.collect_list(code).alias("codes"))
        .groupBy(*by).agg(F.count("*").alias("counties"), F.flatten(F.collect_list("codes")).alias("codes"))
    )
    means = (
        years.select(*by, "counties", F.inline_outer("codes"))
        .groupBy(*by, "counties", "category").agg(F.sum("share").alias("total"))
        .withColumn("mean", F.col("total") / F.col("counties"))
    )
    yearly = means.groupBy(*by).agg(F.sum(F.col("mean") * rate).alias("rate"), F.max("mean").alias("peak"))
    peak = F.max("peak").over(Window.partitionBy(*area))
    scaled = F.col("rate") / F.when(peak > 1, 100.0).otherwise(1.0)
    return yearly.withColumn("rate", scaled).select(
        *by, F.when(F.col("rate") != 0, F.col("rate")).alias("expected_per_day")
    )


def county_order(panel: DataFrame, column: str = UNEMPLOYMENT, area=("state_name",)) -> DataFrame:
    """Counties of an area ranked by their mean over the years, highest first."""
    means = panel.groupBy(*area, "county_name").agg(F.avg(column).alias("mean"))
    order = Window.partitionBy(*area).orderBy(settled(F.col("mean")).desc_nulls_last(), "county_name")
    return means.withColumn("position", F.row_number().over(order))


def county_year_matrix(
    panel: DataFrame, column: str, years: list[int] | None = None, order_by: str = UNEMPLOYMENT,
    area=("state_name",),
) -> DataFrame:
    """Counties by years, in the order of `county_order`; counties without values are left out.

    The yearly cells and the mean that orders the rows come from one aggregate. With
    `years` the schema is known up front; without it a first job looks the years up.
    """
    if years is None:
        years = [row[0] for row in distinct_years(panel).collect()]
    names = [f"y{year}" for year in years]
    cells = [
        F.avg(F.when(F.col("survey_year") == year, F.col(column))).alias(name)
        for year, name in zip(years, names)
    ]
    order = Window.partitionBy(*area).orderBy(settled(F.col("mean")).desc_nulls_last(), "county_name")
    return (
        panel.groupBy(*area, "county_name")
        .agg(F.avg(order_by).alias("mean"), *cells)
        .withColumn("position", F.row_number().over(order))
        .dropna(how="all", subset=names)
        .select(*area, "position", "county_name", *names)
        .orderBy(*area, "position")
    )


def bubble_table(panel: DataFrame, x: str = UNEMPLOYMENT, y: str = EXCELLENT) -> DataFrame:
    """Points of the county comparison: two measures, the labour force as a stand-in for
    population, and the size drawn for it."""
    return panel.select(
        "state_name", *PLACE_TIME, x, y,
        F.col("labor_force_mean").alias("pop_weight"),
        (F.col("labor_force_mean") / 500).alias("bubble_size"),
    )


def extreme_counties(
    panel: DataFrame, k: int = 3, x: str = UNEMPLOYMENT, y: str = EXCELLENT, by=BY_STATE_YEAR
) -> DataFrame:
    """Counties among the k highest or lowest of either measure within `by`.

    One row per county however many of the four lists it is on, with a mark for each.
    Missing values come last in every list and ties go to the first name.
    """
    marks = {}
    for column, label in ((x, "x"), (y, "y")):
        for prefix, order in (
            ("top", settled(F.col(column)).desc_nulls_last()),
            ("low", settled(F.col(column)).asc_nulls_last()),
        ):
            place = Window.partitionBy(*by).orderBy(order, "county_name")
            marks[f"{prefix}_{label}"] = F.row_number().over(place) <= k
    listed = F.col("top_x") | F.col("low_x") | F.col("top_y") | F.col("low_y")
    columns = [*dict.fromkeys([*by, *PLACE_TIME]), x, y]
    return panel.select(*columns, *[m.alias(n) for n, m in marks.items()]).where(listed)


def distinct_years(panel: DataFrame) -> DataFrame:
    return panel.select("survey_year").distinct().orderBy("survey_year")


def describe_panel(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of each column, one row each."""
    long = panel.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "measure", "value"
    )
    return long.groupBy("measure").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def correlations(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each pair of columns, all in one aggregate; NULL for a column without spread."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]

    def correlation(a: str, b: str):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    one_row = panel.agg(*[correlation(a, b).alias(str(i)) for i, (a, b) in enumerate(pairs)])
    entries = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(str(i)).alias("r"))
        for i, (a, b) in enumerate(pairs)
    ])
    return one_row.select(F.inline(entries))


def yearly_change(panel: DataFrame, column: str, place=("fips",), area=("state_name",)) -> DataFrame:
    """Change of a measure against the year before; NULL where the place lacks that year or its value."""
    year_before = Window.partitionBy(*place).orderBy("survey_year").rangeBetween(-1, -1)
    before = F.avg(column).over(year_before)
    return panel.select(*dict.fromkeys([*place, *area, *PLACE_TIME]), column, (F.col(column) - before).alias("change"))
