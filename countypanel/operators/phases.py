"""Rises and falls of a monthly series, cut at its peaks and troughs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = 1_000_000
LEAST_MONTHS = 6
STATE = "array<struct<score:bigint,fewer:int,turns:array<int>,direction:int,length:int>>"


def state_rates(months: DataFrame, names: DataFrame) -> DataFrame:
    """Monthly unemployment rate of each state, of the counties that report both numbers."""
    both = months.where((F.col("month") <= 12) & F.col("unemployment").isNotNull() & F.col("labor_force").isNotNull())
    sums = both.groupBy("state_fips", "year", "month").agg(F.sum("unemployment").alias("u"), F.sum("labor_force").alias("l"))
    return sums.join(names, "state_fips").select(
        F.lit("state").alias("level"), F.col("state_name").alias("place"), "year", "month",
        (100 * F.try_divide("u", "l")).alias("rate"))


def county_rates(months: DataFrame) -> DataFrame:
    return months.where(F.col("month") <= 12).select(
        F.lit("county").alias("level"), F.col("fips").alias("place"), "year", "month", F.col("unemployment_rate").alias("rate"))


def best_phases(values: Column, least: int, cost: int) -> Column:
    """The best cut of an array of whole numbers into rises and falls, as one state with its turning points.

    A state is the best cut so far that ends in a direction and has lasted a number of steps, `least` standing for that and
    more: 2 * least states, however long the series. Each step carries a state on, or turns it if it has lasted.
    """
    def state(score: Column, turns: Column, direction: Column, length: Column) -> Column:
        return F.struct(
            score.cast("long").alias("score"), (-F.size(turns)).alias("fewer"), turns.alias("turns"),
            direction.cast("int").alias("direction"), length.cast("int").alias("length"))

    def step(states: Column, i: Column) -> Column:
        change = F.element_at(values, i + 1) - F.element_at(values, i)
        carried = F.transform(states, lambda s: state(
            s["score"] + s["direction"] * change, s["turns"], s["direction"], F.least(s["length"] + 1, F.lit(least))))
        lasting = F.filter(states, lambda s: s["length"] == least)
        turned = F.transform(lasting, lambda s: state(
            s["score"] - s["direction"] * change - F.lit(cost), F.concat(s["turns"], F.array(i - 1)), -s["direction"], F.lit(1)))
        reached = F.concat(carried, turned)

        def lasted(direction: int) -> Column:
            return F.array_max(F.filter(reached, lambda s: (s["length"] == least) & (s["direction"] == direction)))

        young = F.filter(reached, lambda s: s["length"] < least)
        return F.concat(young, F.filter(F.array(lasted(1), lasted(-1)), lambda s: s.isNotNull())).cast(STATE)

    none = F.array().cast("array<int>")
    change = F.element_at(values, 2) - F.element_at(values, 1)
    start = F.array(*[state(F.lit(d) * change, none, F.lit(d), F.lit(1)) for d in (1, -1)]).cast(STATE)
    steps = F.when(F.size(values) > 2, F.sequence(F.lit(2), F.size(values) - 1)).otherwise(none)
    states = F.aggregate(steps, start, step)
    return F.array_max(F.coalesce(
        F.when(F.exists(states, lambda s: s["length"] == least), F.filter(states, lambda s: s["length"] == least)), states))


def downturn_phases(rates: DataFrame, least_months: int = LEAST_MONTHS, least_swing: float = 0.0) -> DataFrame:
    """Rises and falls of every place's monthly rate: number, direction, the turning point that ends it, and both ends.

    `rates` are (level, place, year, month, rate). Of all cuts into rises and falls in turn, none shorter than `least_months`, that one
    counts whose movements in the directions of its phases add up to the most, each turn costing `least_swing`. Of cuts as good, the one with fewer
    turns, then with later ones, then that which ends in a rise. Rates count to six decimals, so that sums are exact and ties are ties.

    Months without a rate are left out, and phases are counted in the months there are; a month that repeats counts by
    its mean. A series shorter than a phase is one phase, a single month none. The last phase has no turning point yet.
    A place's months, some hundreds, are one array; the search keeps 2 * least_months states on the way through it.
    """
    whole = rates.where(F.col("rate").isNotNull()).groupBy("level", "place", "year", "month").agg(F.avg("rate").alias("rate"))
    series = whole.groupBy("level", "place").agg(F.array_sort(F.collect_list(F.struct(
        (F.col("year") * 100 + F.col("month")).cast("int").alias("month"), F.round(F.col("rate") * UNITS).cast("long").alias("value")))).alias("points"))
    values = F.col("points.value")
    found = series.where(F.size("points") > 1).withColumn("cut", best_phases(values, least_months, round(least_swing * UNITS)))
    turns = F.col("cut.turns")
    ends = F.concat(turns, F.array(F.size("points") - 1))
    begins = F.concat(F.array(F.lit(0)), turns)
    phases = found.select("level", "place", "points", F.col("cut.direction").alias("last"), F.posexplode(F.arrays_zip(
        begins.alias("begin"), ends.alias("end"))).alias("phase", "span"), F.size("cut.turns").alias("turns"))
    rise = F.col("last") * F.when((F.col("turns") - F.col("phase")) % 2 == 0, 1).otherwise(-1) > 0
    first, last = F.element_at("points", F.col("span.begin") + 1), F.element_at("points", F.col("span.end") + 1)
    ended = F.col("phase") < F.col("turns")
    return phases.select(
        "level", "place", (F.col("phase") + 1).alias("phase"),
        F.when(rise, "rise").otherwise("fall").alias("direction"),
        F.when(ended, F.when(rise, "peak").otherwise("trough")).alias("turning_point"),
        first["month"].alias("from_month"), last["month"].alias("to_month"),
        (F.col("span.end") - F.col("span.begin")).alias("months"),
        (first["value"] / UNITS).alias("from_rate"), (last["value"] / UNITS).alias("to_rate"),
        ((last["value"] - first["value"]) / UNITS).alias("change"))
