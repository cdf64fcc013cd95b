"""Counties sorted into classes: median quadrants, income tertiles, and how the two agree.

Cut-offs are exact. Groups are the counties of one area and year, a few thousand at the
most, so a window over a group is small however large the survey behind it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formats import money, one_decimal, settled
from ..functions.missing import flag
from ..functions.names import name_key, strip_suffix_text
from .panel import BY_STATE_YEAR, EXCELLENT, UNEMPLOYMENT

NO_DATA = "No data"
NO_DATA_COLOR = "#000000"

# Names and colours of the quadrants by (low health, high unemployment).
QUADRANTS = {
    (0, 0): ("Low unemployment + High % Excellent Health", "#2ca25f"),
    (0, 1): ("High unemployment + High % Excellent Health", "#1f9fb5"),
    (1, 0): ("Low unemployment + Low % Excellent Health", "#fdae61"),
    (1, 1): ("High unemployment + Low % Excellent Health", "#d73027"),
}
# Colours of the income brackets.
BRACKET_COLORS = {"Low": "#d73027", "Middle": "#fee08b", "High": "#1a9850"}
# Bracket and quadrant that count as agreeing, with the name of the agreement.
AGREEMENTS = {
    "Green ↔ Green": ("High", (0, 0)),
    "Middle ↔ Teal": ("Middle", (0, 1)),
    "Middle ↔ Yellow": ("Middle", (1, 0)),
    "Red ↔ Red": ("Low", (1, 1)),
}
MISMATCH = "Mismatch"


def cutoffs(panel: DataFrame, x=UNEMPLOYMENT, y=EXCELLENT, by=BY_STATE_YEAR) -> DataFrame:
    """Medians of both measures per area and year."""
    return panel.groupBy(*by).agg(F.median(x).alias("x_cut"), F.median(y).alias("y_cut"))


def quadrants(panel: DataFrame, x=UNEMPLOYMENT, y=EXCELLENT, by=BY_STATE_YEAR) -> DataFrame:
    """High or low unemployment and health against the medians of the group.

    The medians are window aggregates: the panel is computed once and not joined back
    to itself. A missing measure counts as "not above" and "not at or below".
    """
    group = Window.partitionBy(*by)
    state = [c for c in ("state_name",) if c in panel.columns]
    binned = panel.select(
        *dict.fromkeys([*state, *by, "county_name", "survey_year"]), x, y,
        flag(settled(F.col(x)) > settled(F.median(x).over(group))).alias("u_bin"),
        flag(settled(F.col(y)) <= settled(F.median(y).over(group))).alias("h_bin"),
    )
    label = color = F.lit(None).cast("string")
    for (low_health, high_unemployment), (name, paint) in QUADRANTS.items():
        here = (F.col("h_bin") == low_health) & (F.col("u_bin") == high_unemployment)
        label = F.when(here, name).otherwise(label)
        color = F.when(here, paint).otherwise(color)
    return binned.withColumns({"quadrant": label, "color": color})


def income_tertiles(
    income: DataFrame, column: str = "median_income", by=BY_STATE_YEAR
) -> DataFrame:
    """Income bracket of each county: Low, Middle or High third of its group.

    Edges are interpolated quantiles and belong to the lower bracket, so equal incomes
    share a bracket. With one or two different incomes the range is cut in three equal
    parts instead: two values are Low and High, a single one is Middle.
    """
    known = income.where(F.col(column).isNotNull())
    group = Window.partitionBy(*by)
    value = F.col(column)
    third = F.percentile(column, F.array(F.lit(1 / 3), F.lit(2 / 3)))
    marked = known.withColumns({
        "edges": third.over(group),
        "lowest": F.min(column).over(group),
        "highest": F.max(column).over(group),
    })
    extreme = (value == F.col("lowest")) | (value == F.col("highest"))
    marked = marked.withColumn("few", F.every(extreme).over(group))
    by_range = (
        F.when(F.col("lowest") == F.col("highest"), "Middle")
        .when(value == F.col("lowest"), "Low")
        .otherwise("High")
    )
    by_edge = (
        F.when(value <= F.col("edges")[0], "Low")
        .when(value <= F.col("edges")[1], "Middle")
        .otherwise("High")
    )
    bracket = F.when(F.col("few"), by_range).otherwise(by_edge)
    return marked.withColumn("income_bracket", bracket).drop("edges", "lowest", "highest", "few")


def coinciding_edges(
    income: DataFrame, column: str = "median_income", by=BY_STATE_YEAR
) -> DataFrame:
    """Groups whose two tertile edges fall on one value, so that no county is Middle."""
    edges = F.percentile(column, F.array(F.lit(1 / 3), F.lit(2 / 3)))
    found = income.groupBy(*by).agg(edges.alias("edges"), F.count_distinct(column).alias("values"))
    return found.where((F.col("values") >= 3) & (F.col("edges")[0] == F.col("edges")[1]))


def area_median(income: DataFrame, column: str = "median_income", by=BY_STATE_YEAR) -> DataFrame:
    """Median income over the counties of a group, as number and as text."""
    return income.groupBy(*by).agg(F.median(column).alias("median")).withColumn(
        "median_text", money(F.col("median"))
    )


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in the given order.

    The smallest struct is an aggregate with map-side combining, so what a key with very
    many rows moves is one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, "first.*").select(*df.columns)


def common_years(left: DataFrame, right: DataFrame, first: int, last: int) -> DataFrame:
    """Years in both tables within a closed range."""
    years = [
        t.where(F.col("survey_year").between(first, last)).select("survey_year")
        for t in (left, right)
    ]
    return years[0].intersect(years[1])


def matching_classes(
    classes: DataFrame, incomes: DataFrame, state: str | Column, abbreviation: str | Column,
    by=BY_STATE_YEAR,
) -> DataFrame:
    """Quadrant and income bracket of the counties that both tables know.

    Matched on area, year and the normalised name; of counties sharing a key the first
    by name counts.
    """
    keyed = classes.withColumn("county_key", name_key(F.col("county_name"), state, abbreviation))
    keys = [*by, "county_key"]
    left = first_by_key(keyed.select(*keys, "county_name", "quadrant"), keys, ["county_name"])
    return left.join(incomes.select(*keys, "income_bracket"), keys, "inner")


def with_agreement(matched: DataFrame) -> DataFrame:
    verdict = F.lit(MISMATCH)
    for name, (bracket, position) in AGREEMENTS.items():
        same = (F.col("income_bracket") == bracket) & (F.col("quadrant") == QUADRANTS[position][0])
        verdict = F.when(same, name).otherwise(verdict)
    return matched.withColumn("alignment", verdict)


def agreement_by_year(matched: DataFrame, by=BY_STATE_YEAR) -> DataFrame:
    """Count and percent of counties per kind of agreement and year."""
    counts = with_agreement(matched).groupBy(*by, "alignment").agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(*by))
    return counts.withColumn("percent", one_decimal(F.col("count") / total * 100))


def agreement_wide(agreement: DataFrame, by=BY_STATE_YEAR) -> DataFrame:
    """One row per year, one column per kind of agreement, 0 where none."""
    kinds = [*AGREEMENTS, MISMATCH]
    wide = agreement.groupBy(*by).pivot("alignment", kinds).agg(F.first("percent"))
    return wide.na.fill(0.0, subset=kinds).orderBy(*by)


def quadrant_map(
    features: DataFrame, classes: DataFrame, years: list[int], suffix: str | Column = " County, CA",
    x: str = UNEMPLOYMENT, y: str = EXCELLENT,
) -> DataFrame:
    """Map attributes of every feature and year; black and "No data" where nothing matches.

    Features carry `state_name` and `feature_name`; classes match within their state by
    county name without `suffix`.
    """
    lookup = classes.select(
        "state_name", "survey_year",
        strip_suffix_text(F.col("county_name"), suffix).alias("feature_name"),
        "color", "quadrant", one_decimal(F.col(x)).alias("unemp_pct"),
        one_decimal(F.col(y)).alias("excellent_pct"),
    )
    wanted = features.withColumn("survey_year", F.explode(F.array(*[F.lit(v) for v in years])))
    return wanted.join(lookup, ["state_name", "survey_year", "feature_name"], "left").withColumns({
        "color": F.coalesce("color", F.lit(NO_DATA_COLOR)),
        "quadrant": F.coalesce("quadrant", F.lit(NO_DATA)),
    })


def tertile_map(
    features: DataFrame, brackets: DataFrame, years: list[int], state: str | Column,
    abbreviation: str | Column,
) -> DataFrame:
    """Income attributes of every feature and year, matched within the state by normalised name."""
    lookup = brackets.select(
        "state_name", "survey_year", "county_key", F.col("median_income").cast("long").alias("mhi"),
        "income_bracket",
    )
    wanted = features.select(
        "state_name",
        F.explode(F.array(*[F.lit(v) for v in years])).alias("survey_year"),
        "feature_name",
        name_key(F.col("feature_name"), state, abbreviation).alias("county_key"),
    )
    color = F.lit(NO_DATA_COLOR)
    for bracket, paint in BRACKET_COLORS.items():
        color = F.when(F.col("income_bracket") == bracket, paint).otherwise(color)
    return wanted.join(lookup, ["state_name", "survey_year", "county_key"], "left").select(
        "state_name", "survey_year", "feature_name", "county_key", "mhi",
        F.coalesce(money(F.col("mhi")), F.lit(NO_DATA)).alias("mhi_fmt"),
        F.coalesce("income_bracket", F.lit(NO_DATA)).alias("mhi_bracket"),
        color.alias("fill_col"),
    )
