"""Least squares with several regressors, and with county and year effects.

What the data give is one matrix of sums of products for each group, an aggregate that merges from parts; all that follows
is arithmetic on its few numbers in columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_folder, written
from .regression import two_sided_p

DEPENDENT = 1e-9
CONVERGED = 1e-11
MOST_ROUNDS = 10_000


def entry(matrix: str, i: int, j: int) -> Column:
    """An entry of a symmetric matrix held as its lower triangle, row by row."""
    i, j = max(i, j), min(i, j)
    return F.col(matrix)[i * (i + 1) // 2 + j]


def triangle(k: int, value: Callable[[int, int], Column]) -> Column:
    return F.array(*[value(i, j) for i in range(k) for j in range(i + 1)])


def total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0.0)


def solved(sums: DataFrame, k: int) -> DataFrame:
    """Adds `inverse`, the inverse of the k regressors' products `xx`, and `beta`, the solution for `xy`; both NULL where
    the regressors depend on each other.

    The Cholesky factor is that of the regressors scaled to length one, in which a diagonal entry is the part of a
    regressor that those before it do not explain: dependence is seen whatever the units.
    """
    steps = sums.withColumn("size", F.array(*[F.sqrt(entry("xx", i, i)) for i in range(k)]))
    # a column for each row of the factor, made from those above it
    for i in range(k):
        row: list[Column] = []
        for j in range(i):
            scaled = F.try_divide(entry("xx", i, j), F.col("size")[i] * F.col("size")[j])
            known = total([row[m] * F.col(f"factor{j}")[m] for m in range(j)])
            row.append(F.try_divide(scaled - known, F.col(f"factor{j}")[j]))
        steps = steps.withColumn(f"left{i}", F.array(*row) if row else F.array().cast("array<double>"))
        rest = 1 - total([F.col(f"left{i}")[m] * F.col(f"left{i}")[m] for m in range(i)])
        steps = steps.withColumn(f"rest{i}", F.when(F.col("size")[i] > 0, rest))
        steps = steps.withColumn(f"factor{i}", F.concat(f"left{i}", F.array(F.when(F.col(f"rest{i}") > DEPENDENT, F.sqrt(f"rest{i}")))))
    # the factor's inverse, row by row, and from it the inverse of the products
    for i in range(k):
        below = [
            -total([F.col(f"factor{i}")[m] * F.col(f"turned{m}")[j] for m in range(j, i)]) / F.col(f"factor{i}")[i] for j in range(i)]
        steps = steps.withColumn(f"turned{i}", F.array(*below, 1 / F.col(f"factor{i}")[i]))

    def inverse(i: int, j: int) -> Column:
        return total([F.col(f"turned{m}")[i] * F.col(f"turned{m}")[j] for m in range(max(i, j), k)]) / (F.col("size")[i] * F.col("size")[j])

    whole = reduce(lambda a, b: a & b, [F.col(f"factor{i}")[i].isNotNull() for i in range(k)])
    steps = steps.withColumn("inverse", F.when(whole, triangle(k, inverse)))
    steps = steps.withColumn("beta", F.when(whole, F.array(*[
        total([entry("inverse", i, j) * F.col("xy")[j] for j in range(k)]) for i in range(k)])))
    made = [f"{name}{i}" for i in range(k) for name in ("left", "rest", "factor", "turned")]
    return steps.drop("size", *made)


def fit_planes(panel: DataFrame, outcomes: list[str], regressors: list[str], by=("state_name",)) -> DataFrame:
    """Least squares of every outcome on several regressors and a constant, within `by`.

    One row for each group, outcome and term (`intercept` first): n, coef, se, t, p, and the fit's r2, adj_r2 and f. Rows with a missing value
    are left out, for the outcome that lacks it. Coefficients are NULL where regressors depend on each
    other or have no spread, or rows are fewer than terms; errors are NULL without degrees of freedom.
    """
    k = len(regressors)
    long = panel.select(*by, *regressors, *outcomes).unpivot([*by, *regressors], outcomes, "outcome", "y")
    whole = long.dropna(subset=[*regressors, "y"])
    products = whole.groupBy(*by, "outcome").agg(
        F.count("*").alias("n"), F.avg("y").alias("mean_y"), F.array(*[F.avg(c) for c in regressors]).alias("mean_x"),
        triangle(k, lambda i, j: F.covar_pop(regressors[i], regressors[j])).alias("cov"),
        F.array(*[F.covar_pop(c, "y") for c in regressors]).alias("cov_y"), F.var_pop("y").alias("var_y"))
    sums = products.select(
        *by, "outcome", "n", "mean_y", "mean_x", F.transform("cov", lambda c: c * F.col("n")).alias("xx"),
        F.transform("cov_y", lambda c: c * F.col("n")).alias("xy"), (F.col("var_y") * F.col("n")).alias("yy"))
    free = F.col("n") - k - 1
    fits = (
        solved(sums, k)
        .withColumn("beta", F.when(free >= 0, F.col("beta")))
        .withColumn("explained", total([F.col("beta")[i] * F.col("xy")[i] for i in range(k)]))
        .withColumn("rss", F.greatest(F.lit(0.0), F.col("yy") - F.col("explained")))
        .withColumn("free", F.when(free > 0, free))
        .withColumn("mse", F.col("rss") / F.col("free"))
        .withColumn("r2", F.when(F.col("explained").isNotNull(), F.try_divide("explained", "yy")))
    )
    at_mean = total([entry("inverse", i, j) * F.col("mean_x")[i] * F.col("mean_x")[j] for i in range(k) for j in range(k)])
    intercept = F.col("mean_y") - total([F.col("beta")[i] * F.col("mean_x")[i] for i in range(k)])
    terms = [("intercept", intercept, F.sqrt(F.col("mse") * (1 / F.col("n") + at_mean)))]
    terms += [(c, F.col("beta")[i], F.sqrt(F.col("mse") * entry("inverse", i, i))) for i, c in enumerate(regressors)]
    rows = F.array(*[F.struct(F.lit(name).alias("term"), coef.alias("coef"), se.alias("se")) for name, coef, se in terms])
    return fits.select(
        *by, "outcome", "n", F.inline(rows), "free", "r2",
        (1 - (1 - F.col("r2")) * (F.col("n") - 1) / F.col("free")).alias("adj_r2"),
        F.try_divide(F.col("explained") / k, F.col("mse")).alias("f"),
    ).withColumn("t", F.try_divide("coef", "se")).withColumn("p", two_sided_p(F.col("t"), F.col("free"))).select(
        *by, "outcome", "term", "n", "coef", "se", "t", "p", "r2", "adj_r2", "f")


def cell_effects(rows: DataFrame, columns: list[str], place: str, year: str, folder: str) -> DataFrame:
    """(place, year, n, removed array): what place and year effects together take from each column, by alternating means.

    Works on one row for each place and year, as the rows of a cell share their effects: their number and means are gathered
    once, and every half round takes the means of the places, or of the years, out of the cells. Rounds are
    written tables and end when no mean exceeds CONVERGED of its column's spread; on a panel without gaps
    that is after the first. Only that one number reaches the driver.
    """
    k = len(columns)
    cells = rows.groupBy(place, year).agg(
        F.count("*").alias("n"), F.array(*[F.avg(c) for c in columns]).alias("mean"))
    cells = written(cells, f"{folder}/cells")
    spread = rows.agg(*[F.stddev_pop(c).alias(str(i)) for i, c in enumerate(columns)]).first()
    scale = [float(s) if s else 1.0 for s in spread]

    def without(cells: DataFrame, by: str, turn: int) -> tuple[DataFrame, float]:
        means = cells.groupBy(by).agg(F.array(*[
            F.sum(F.col("n") * F.col("left")[i]) / F.sum("n") for i in range(k)]).alias("__mean"))
        means = written(means, f"{folder}/means-{turn}-{by}")
        largest = means.agg(*[F.max(F.abs(F.col("__mean")[i])).alias(str(i)) for i in range(k)]).first()
        moved = cells.join(means, by).withColumn("left", F.zip_with("left", "__mean", lambda a, b: a - b)).drop("__mean")
        return written(moved.select(place, year, "n", "mean", "left"), f"{folder}/left-{turn}-{by}"), max(
            (abs(m) / s for m, s in zip(largest, scale) if m is not None), default=0.0)

    now = cells.withColumn("left", F.col("mean"))
    if cells.isEmpty():
        return cells.select(place, year, "n", F.col("mean").alias("removed"))
    for turn in range(MOST_ROUNDS):
        now, first = without(now, place, turn)
        now, second = without(now, year, turn)
        if turn and max(first, second) <= CONVERGED:
            return now.select(place, year, "n", F.zip_with("mean", "left", lambda a, b: a - b).alias("removed"))
    raise RuntimeError(f"effects did not settle in {MOST_ROUNDS} rounds")


def fit_with_effects(panel: DataFrame, outcome: str, regressors: list[str], place: str = "fips", year: str = "survey_year") -> DataFrame:
    """Least squares of an outcome on regressors with an effect for every place and every year; errors clustered by place.

    One row for each regressor: n, places, years, coef, se, t, p, and within_r2. Equals the fit with a dummy
    for each place and year. Errors are the clustered sandwich times places / (places - 1) * (n - 1) / (n - terms), where
    terms are regressors, places and years less one; t has places - 1 degrees of freedom. Rows with a missing value are left
    out. Coefficients are NULL where regressors depend on each other or do not vary beyond the effects.

    The rows are read to gather cells and once more to sum products by place; the errors come from these sums, not from the rows.
    """
    k = len(regressors)
    folder = scratch_folder(panel.sparkSession, "effects")
    names = [*regressors, outcome]
    rows = panel.select(place, year, *[F.col(c).cast("double").alias(c) for c in names]).dropna()
    removed = cell_effects(rows, names, place, year, folder)
    within = rows.join(removed.select(place, year, "removed"), [place, year]).select(
        place, F.array(*[F.col(c) - F.col("removed")[i] for i, c in enumerate(names)]).alias("v"),
        F.array(*[F.col(c) for c in names]).alias("raw"))
    v = F.col("v")
    by_place = written(within.groupBy(place).agg(
        F.count("*").alias("n"), triangle(k, lambda i, j: F.sum(v[i] * v[j])).alias("xx"),
        F.array(*[F.sum(v[i] * v[k]) for i in range(k)]).alias("xy"), F.sum(v[k] * v[k]).alias("yy"),
        F.array(*[F.sum(F.col("raw")[i] * F.col("raw")[i]) for i in range(k)]).alias("raw")), f"{folder}/products")
    sums = by_place.agg(
        F.sum("n").alias("n"), F.count("*").alias("places"), triangle(k, lambda i, j: F.sum(entry("xx", i, j))).alias("xx"),
        F.array(*[F.sum(F.col("xy")[i]) for i in range(k)]).alias("xy"), F.sum("yy").alias("yy"),
        F.array(*[F.sum(F.col("raw")[i]) for i in range(k)]).alias("raw"))
    # what rounding leaves of a regressor that the effects explain in full is no spread
    kept = [F.when(entry("xx", i, i) > 1e-12 * F.col("raw")[i], entry("xx", i, i)) for i in range(k)]
    sums = sums.withColumn("xx", triangle(k, lambda i, j: kept[i] if i == j else entry("xx", i, j)))
    fit = solved(sums, k).first()  # one row of a few numbers
    years = removed.agg(F.countDistinct(year)).first()[0]
    known = {c: F.lit(fit[c]) if fit[c] is not None else F.lit(None).cast("array<double>") for c in ("beta", "inverse", "xx", "xy")}
    score = [F.col("xy")[i] - total([entry("xx", i, j) * known["beta"][j] for j in range(k)]) for i in range(k)]
    scores = by_place.select(F.array(*score).alias("s"))
    meat = scores.agg(triangle(k, lambda i, j: F.sum(F.col("s")[i] * F.col("s")[j])).alias("meat")).withColumn("inverse", known["inverse"])
    n, places = fit["n"] or 0, fit["places"]
    terms = k + places + years - 1
    scale = F.lit(places * (n - 1) / ((places - 1) * (n - terms)) if places > 1 and n > terms else None).cast("double")

    def variance(i: int) -> Column:
        return scale * total([
            entry("inverse", i, a) * entry("meat", a, b) * entry("inverse", b, i) for a in range(k) for b in range(k)])

    explained = total([known["beta"][i] * known["xy"][i] for i in range(k)])
    found = [F.struct(F.lit(c).alias("term"), known["beta"][i].alias("coef"), F.sqrt(variance(i)).alias("se")) for i, c in enumerate(regressors)]
    return (
        meat.select(
            F.lit(outcome).alias("outcome"), F.lit(n).cast("long").alias("n"), F.lit(places).cast("long").alias("places"),
            F.lit(years).cast("long").alias("years"), F.try_divide(explained, F.lit(fit["yy"]).cast("double")).alias("within_r2"), F.inline(F.array(*found)))
        .withColumn("t", F.try_divide("coef", "se")).withColumn("p", two_sided_p(F.col("t"), F.lit(max(places - 1, 0)).cast("long")))
        .select("outcome", "term", "n", "places", "years", "coef", "se", "t", "p", "within_r2")
    )
