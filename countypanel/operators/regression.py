"""Simple regressions with intercept, one per outcome and group, from one aggregate."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .panel import UNEMPLOYMENT

OUTCOMES = [
    "general_health_status_Excellent_w", "general_health_status_Excellent_uw",
    "general_health_status_Poor_w", "general_health_status_Poor_uw",
]


def fit_lines(
    panel: DataFrame, outcomes: list[str] = OUTCOMES, x: str = UNEMPLOYMENT, by=("state_name",)
) -> DataFrame:
    """Least-squares line of every outcome on `x` within `by`: n, slope, intercept, R2.

    Outcomes become rows, so the panel is read once for all of them. Pairs with a missing
    value are left out.
    """
    outcome, value = F.col("outcome"), F.col("value")
    long = panel.select(*by, x, *outcomes).unpivot([*by, x], outcomes, "outcome", "value")
    pair = (value, F.col(x))
    return long.groupBy(*by, outcome).agg(
        F.regr_count(*pair).alias("n"),
        F.regr_slope(*pair).alias("slope"),
        F.regr_intercept(*pair).alias("intercept"),
        F.regr_r2(*pair).alias("r2"),
        F.regr_avgx(*pair).alias("mean_x"),
        F.regr_sxx(*pair).alias("sxx"),
        F.regr_syy(*pair).alias("syy"),
        F.regr_sxy(*pair).alias("sxy"),
    )


def fit_summary(fits: DataFrame) -> DataFrame:
    """Adjusted R2, standard errors, t and F values, log-likelihood, AIC and BIC of the fits.

    Closed forms of the sums in `fit_lines`; NULL where a fit has no degrees of freedom
    or no spread.
    """
    n, sxx = F.col("n"), F.col("sxx")
    explained = F.try_divide(F.col("sxy") * F.col("sxy"), sxx)
    free = F.when(n > 2, n - 2)
    steps = fits.withColumn("rss", F.col("syy") - explained).withColumn(
        "mse", F.try_divide(F.col("rss"), free)
    )
    se_slope = F.sqrt(F.try_divide(F.col("mse"), sxx))
    se_intercept = F.sqrt(
        F.col("mse") * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.pow("mean_x", F.lit(2)), sxx))
    )
    spread = F.when(F.col("rss") > 0, F.col("rss") / n)
    loglik = -n / 2 * (F.lit(math.log(2 * math.pi)) + F.log(spread) + 1)
    groups = [c for c in fits.columns if c not in ("mean_x", "sxx", "syy", "sxy")]
    return (
        steps.withColumns({"se_slope": se_slope, "se_intercept": se_intercept, "loglik": loglik})
        .select(
            *groups,
            (1 - (1 - F.col("r2")) * F.try_divide(n - 1, free)).alias("adj_r2"),
            "se_slope",
            "se_intercept",
            F.try_divide("slope", "se_slope").alias("t_slope"),
            F.try_divide("intercept", "se_intercept").alias("t_intercept"),
            F.try_divide(explained, F.col("mse")).alias("f_value"),
            "loglik",
            (4 - 2 * F.col("loglik")).alias("aic"),
            (2 * F.log(n) - 2 * F.col("loglik")).alias("bic"),
        )
    )


def two_sided_p(t: Column, free: Column) -> Column:
    """P(|T| > |t|) for Student's t with whole degrees of freedom.

    With x = free / (free + t * t) the probability is a series of positive terms, each
    the last one times x * (2 j - 1 + odd) / (2 j + odd). Its first free / 2 terms sum to the inside,
    the rest to the tail; the larger part of the two is not computed by subtraction, so that small
    tails keep their digits. The tail ends where its terms no longer count.
    """
    free = F.when(free > 0, free).cast("long")
    size = F.abs(t)
    odd = free % 2
    half = F.floor(free / 2)
    x = free / (free + size * size)
    angle = F.atan2(size, F.sqrt(free))
    scale = F.when(odd == 1, F.lit(2 / math.pi) * F.sin(angle) * F.cos(angle)).otherwise(F.sin(angle))

    def summed(first: Column, last: Column, term: Column) -> Column:
        """`term` and the terms after it, for j from `first` to `last`; (sum, term after the last)."""
        start = F.struct(F.lit(0.0).alias("total"), term.alias("term"))
        steps = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        return F.aggregate(steps, start, lambda s, j: F.struct(
            (s["total"] + s["term"]).alias("total"),
            (s["term"] * x * (2 * j + 1 + odd) / (2 * j + 2 + odd)).alias("term")))

    head = summed(F.lit(0).cast("long"), half - 1, F.lit(1.0))
    inside = scale * head["total"] + F.when(odd == 1, F.lit(2 / math.pi) * angle).otherwise(0.0)
    length = F.ceil(F.lit(45.0) / -F.log(x)).cast("long")
    tail = scale * summed(half, half + length, head["term"])["total"]
    return F.when(size.isNotNull() & ~F.isnan(size) & free.isNotNull(), F.when(inside < 0.5, 1 - inside).otherwise(tail))


def p_values(fits: DataFrame) -> DataFrame:
    """Two-sided p-values of slope and intercept, added to `fit_summary`."""
    free = F.when(F.col("n") > 2, F.col("n") - 2)
    return fit_summary(fits).select(
        "*", *[two_sided_p(F.col(f"t_{c}"), free).alias(f"p_{c}") for c in ("slope", "intercept")])
