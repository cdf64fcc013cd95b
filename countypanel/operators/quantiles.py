"""Exact quantiles of groups of any size, by counting instead of sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written

BINS = 256
FEW_ROWS = 4_096


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, p, n, value): quantiles with linear interpolation between the two neighbouring values.

    A quantile lies between two ranks. For each wanted rank an interval of values is known that holds it, at first that of the
    group's smallest and largest value. A round counts the rows of every interval in BINS bins of equal width, with the smallest and
    largest value of each, and goes on with the bin that the rank falls into; where no more than FEW_ROWS rows are left, it counts by value instead.
    It ends when all intervals are single values. Counts are summed in each task before they are shuffled, so a task passes on
    BINS rows a rank at most, whatever share of the rows a group has; no group is ever gathered or sorted.

    Missing and non-finite values are left out; a group without values has n 0 and no quantile; null keys are a group; equal values are counted each.
    Rounds are written tables, and only the number of open intervals reaches the driver.
    """
    folder = scratch_folder(df.sparkSession, "quantiles")
    x = F.col(f"`{value}`").cast("double")
    usable = F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), x)
    rows = written(df.select(*by, usable.alias("__v")), f"{folder}/rows")
    groups = written(rows.groupBy(*by).agg(
        F.count("__v").alias("__n"), F.min("__v").alias("__low"), F.max("__v").alias("__high")), f"{folder}/groups")
    wanted = groups.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    at = F.col("p") * (F.col("__n") - 1)
    wanted = wanted.withColumn("__first", F.floor(at)).withColumn("__part", at - F.floor(at))
    ranks = wanted.where("__n > 0").select(*by, "__n", "__low", "__high", F.explode(
        F.array(F.col("__first"), F.least(F.col("__first") + 1, F.col("__n") - 1))).alias("__rank")).distinct()
    # ranks with the rows below their interval and in it; keys of a row are compared null-safe through their positions in `by`
    open_ = written(ranks.select(*by, "__rank", F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__in"), "__low", "__high"), f"{folder}/ranks")
    done, turn = [], 0
    while True:
        done.append(open_.where("__low = __high").select(*by, "__rank", F.col("__low").alias("__value")))
        left = open_.where("__low < __high")
        if left.isEmpty():
            break
        open_, turn = written(narrowed(rows, left, by), f"{folder}/round-{turn}"), turn + 1
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = written(found, f"{folder}/found")
    lower = found.select(*[F.col(c).alias(f"__a_{c}") for c in by], F.col("__rank").alias("__first"), F.col("__value").alias("__from"))
    upper = found.select(*[F.col(c).alias(f"__b_{c}") for c in by], F.col("__rank").alias("__second"), F.col("__value").alias("__to"))
    wanted = wanted.withColumn("__second", F.least(F.col("__first") + 1, F.col("__n") - 1))
    both = (
        wanted.join(lower, [wanted["__first"] == lower["__first"], *[wanted[c].eqNullSafe(lower[f"__a_{c}"]) for c in by]], "left").drop(lower["__first"])
    )
    both = both.join(upper, [both["__second"] == upper["__second"], *[both[c].eqNullSafe(upper[f"__b_{c}"]) for c in by]], "left").drop(upper["__second"])
    return both.select(*by, "p", F.col("__n").alias("n"), (
        F.col("__from") + F.when(F.col("__part") > 0, F.col("__part") * (F.col("__to") - F.col("__from"))).otherwise(0.0)).alias("value"))


def narrowed(rows: DataFrame, ranks: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Each rank with the bin of its interval that it falls into."""
    asked = ranks.select(*[F.col(c).alias(f"__k_{c}") for c in by], "__rank", "__below", "__in", "__low", "__high")
    inside = [F.col("__v") >= F.col("__low"), F.col("__v") <= F.col("__high")]
    met = rows.join(asked, [*[rows[c].eqNullSafe(asked[f"__k_{c}"]) for c in by], *inside])
    share = (F.col("__v") / 2 - F.col("__low") / 2) / (F.col("__high") / 2 - F.col("__low") / 2)
    few = F.col("__in") <= FEW_ROWS
    counts = met.groupBy(*by, "__rank", "__below", F.when(~few, F.least(F.floor(share * BINS), F.lit(BINS - 1))).alias("__bin"),
                         F.when(few, F.col("__v")).alias("__single")).agg(
        F.count("*").alias("__in"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
    order = Window.partitionBy(*by, "__rank").orderBy("__low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.withColumn("__upto", F.col("__below") + F.sum("__in").over(order))
    hit = upto.where((F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__in")))
    return hit.select(*by, "__rank", (F.col("__upto") - F.col("__in")).alias("__below"), "__in", "__low", "__high")
