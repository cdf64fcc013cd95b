"""Rounding and text forms of results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def settled(col: Column) -> Column:
    """The number without the noise of its last digits, for cuts, ranks and rounding."""
    return F.round(col, 9)


def one_decimal(col: Column) -> Column:
    """Round to one decimal, ties to the even digit.

    The last digits of a mean depend on the order in which its parts were added, so they
    are settled before the decision.
    """
    return F.bround(settled(col), 1)


def money(col: Column) -> Column:
    """"$12,345" for a number; ties to even."""
    return F.concat(F.lit("$"), F.format_number(col, 0))


def matched_of_total(matched: Column, total: Column) -> Column:
    """"matched/total (x.y%)"."""
    share = one_decimal(F.try_divide(F.lit(100.0) * matched, total))
    return F.format_string("%d/%d (%.1f%%)", matched, total, share)
