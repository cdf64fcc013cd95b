"""Comparing years: measures shifted against each other in time, and the change between two years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formats import settled
from ..functions.names import strip_suffix_text
from .panel import UNEMPLOYMENT
from .regression import two_sided_p

LAGS = tuple(range(-3, 4))

# Class of a change and its colour on a map.
CHANGES = {"increase": "#b2182b", "decrease": "#2166ac", "no change": "#f7f7f7", "No data": "#000000"}


def at_year(column: str, move: int, place, year: str = "survey_year") -> Column:
    """A place's value of exactly `move` years later; NULL where the place lacks that year.

    The frame is one of values, not of rows, so a year that is missing does not bring the next one in. Rows that share
    a place and year count by their mean.
    """
    return F.avg(column).over(Window.partitionBy(*place).orderBy(year).rangeBetween(move, move))


def lagged_correlation(
    panel: DataFrame, outcomes: list[str], x: str = UNEMPLOYMENT, lags=LAGS, by=("state_name",), place=("fips",),
) -> DataFrame:
    """Correlation of `x` with each outcome `lag` years later, over the counties and years of `by`: n, r, t and p.

    A positive lag says that the outcome follows. One window by place serves all lags and outcomes, and one aggregate
    all groups; the rows made for lags and outcomes are summed before they are shuffled. Pairs with a missing value
    are left out; r is NULL with fewer than two pairs or without spread, t and p with fewer than three or at |r| = 1.
    """
    cells = [
        F.struct(F.lit(outcome).alias("outcome"), F.lit(lag).alias("lag"), at_year(outcome, lag, place).alias("value"))
        for outcome in outcomes for lag in lags
    ]
    pairs = panel.select(*by, F.col(x).alias("x"), F.array(*cells).alias("cells")).select(*by, "x", F.inline("cells"))
    both = F.when(F.col("x").isNotNull() & F.col("value").isNotNull(), 1)
    sums = pairs.groupBy(*by, "outcome", "lag").agg(
        F.count(both).alias("n"), F.covar_pop("x", "value").alias("together"),
        F.stddev_pop(F.when(both == 1, F.col("x"))).alias("sx"), F.stddev_pop(F.when(both == 1, F.col("value"))).alias("sy"))
    r = F.try_divide(F.col("together"), F.col("sx") * F.col("sy"))
    r = F.when((F.col("n") > 1) & r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    inner = 1 - F.col("r") * F.col("r")
    t = F.when((F.col("n") > 2) & (settled(inner) > 0), F.col("r") * F.sqrt((F.col("n") - 2) / inner))
    return (
        sums.withColumn("r", r).withColumn("t", t)
        .select(*by, "outcome", "lag", "n", "r", "t", two_sided_p(F.col("t"), F.col("n") - 2).alias("p"))
    )


def best_lag(correlations: DataFrame, by=("state_name",), least: int = 3) -> DataFrame:
    """Of each group and outcome the lag with the strongest correlation of at least `least` pairs.

    Ties go to the shorter lag and then to the one at which the outcome follows.
    """
    strength = settled(F.abs(F.col("r")))
    order = Window.partitionBy(*by, "outcome").orderBy(strength.desc(), F.abs(F.col("lag")), F.col("lag").desc())
    return (
        correlations.where((F.col("n") >= least) & F.col("r").isNotNull())
        .withColumn("place", F.row_number().over(order)).where(F.col("place") == 1).drop("place")
    )


def nearest_year(
    observed: DataFrame, wanted: DataFrame, value: str, tolerance: int, place=("fips",), year: str = "survey_year",
) -> DataFrame:
    """Every row of `wanted` (place, wanted_year) with the place's nearest year that has a value, and that value.

    Rows asked for and rows observed stand in one order of years, where the last observed year up to the wanted one and the first
    from it on are running extremes; no row meets more than these two. The nearer one counts, the earlier one
    of two as near, and none beyond `tolerance`.
    """
    seen = F.struct(F.col(year).cast("int").alias("year"), F.col(value).cast("double").alias("value"))
    none = F.lit(None).cast("struct<year:int,value:double>")
    line = (
        observed.where(F.col(value).isNotNull() & F.col(year).isNotNull())
        .select(*place, F.col(year).cast("int").alias("at"), seen.alias("seen"), F.lit(False).alias("asked"))
        .unionByName(wanted.select(*place, F.col("wanted_year").cast("int").alias("at"), none.alias("seen"), F.lit(True).alias("asked")))
    )
    order = Window.partitionBy(*place).orderBy("at")
    before = F.max("seen").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min("seen").over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    found = line.select("*", before.alias("before"), after.alias("after")).where("asked")
    back, ahead = F.col("at") - F.col("before.year"), F.col("after.year") - F.col("at")
    nearer = F.when(back.isNull() | (ahead < back), F.col("after")).otherwise(F.col("before"))
    return found.withColumn("hit", nearer).select(
        *place, F.col("at").alias("wanted_year"),
        *[F.when(F.abs(F.col("hit.year") - F.col("at")) <= tolerance, F.col(f"hit.{c}")).alias(name)
          for c, name in (("year", "found_year"), ("value", "value"))])


def changes_between(
    panel: DataFrame, column: str, first: int, last: int, tolerance: int = 1, place=("fips",), keep=("state_name", "county_name"),
) -> DataFrame:
    """Change of a measure between two years, or the nearest ones that a place has: both years, both values, change,
    change for each year between, and percent of the first value.

    NULL where either year is missing, or where both are the same.
    """
    names = panel.groupBy(*place).agg(*[F.min(c).alias(c) for c in keep])
    asked = names.select(*place, F.explode(F.array(F.lit(first), F.lit(last))).alias("wanted_year"))
    hits = nearest_year(panel, asked, column, tolerance, place)

    def of(year: int, field: str) -> Column:
        return F.max(F.when(F.col("wanted_year") == year, F.col(field)))

    ends = hits.groupBy(*place).agg(
        of(first, "found_year").alias("from_year"), of(last, "found_year").alias("to_year"),
        of(first, "value").alias("from_value"), of(last, "value").alias("to_value"))
    change = F.when(F.col("to_year") > F.col("from_year"), F.col("to_value") - F.col("from_value"))
    return names.join(ends, list(place)).withColumn("change", change).withColumns({
        "yearly": F.col("change") / (F.col("to_year") - F.col("from_year")),
        "percent": 100 * F.try_divide("change", F.abs(F.col("from_value")))})


def difference_map(features: DataFrame, changes: DataFrame, suffix: Column, state: str = "state_name") -> DataFrame:
    """Every feature with its county's change, class and colour. Counties are found by their name without `suffix`.

    A feature without a county, or whose county has no change, is of the class "No data".
    """
    named = changes.select(
        state, strip_suffix_text(F.col("county_name"), suffix).alias("feature_name"),
        "from_year", "to_year", "from_value", "to_value", "change", "yearly", "percent")
    size = settled(F.col("change"))
    kind = (
        F.when(size.isNull(), "No data").when(size > 0, "increase").when(size < 0, "decrease").otherwise("no change")
    )
    colour = F.create_map(*[F.lit(x) for pair in CHANGES.items() for x in pair])
    return (
        features.join(named, [state, "feature_name"], "left").withColumn("class", kind)
        .withColumn("color", colour[F.col("class")])
    )
