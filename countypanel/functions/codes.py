"""County codes, answer codes, period codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .missing import to_number, zero_pad

PLACEHOLDER_COUNTY = "000"
# A text that cleans to the placeholder: its first digits are up to three zeros, or none.
PLACEHOLDER_TEXT = r"(?s)^[^0-9]*0{0,3}([^0-9].*)?$"

# Periods an answer-frequency code counts in, by its hundreds digit,
# with the number of days each stands for (per day, per week, per month).
FREQUENCY_DAYS = {1: 1, 2: 7, 3: 30}


def integer_code(col: Column, width: int) -> Column:
    """Strict code: a whole number padded to `width`.

    A fractional number gives NULL, so one bad row costs one key and shows up in the
    bad-value report.
    """
    number = to_number(col)
    whole = F.when(number == F.floor(number), number.try_cast("long"))
    return zero_pad(whole.cast("string"), width)


def digits_code(col: Column, width: int) -> Column:
    """Lenient code: first run of digits in the text, padded; nothing found gives zeros."""
    digits = F.regexp_extract(col.cast("string"), r"(\d+)", 1)
    return zero_pad(F.coalesce(digits, F.lit("")), width)


def join_codes(state: Column, county: Column) -> Column:
    """State and county part joined; a missing part leaves a short code."""
    return F.concat(F.coalesce(state, F.lit("")), F.coalesce(county, F.lit("")))


def answer_label(col: Column) -> Column:
    """Text of an answer code: numbers as float text ("1.0"), other texts unchanged."""
    return F.coalesce(to_number(col).cast("string"), col.cast("string"))


def month_of_period(col: Column) -> Column:
    """Month number of "M01".."M13"; 13 marks the annual average."""
    return F.substring(F.trim(col), 2, 2).try_cast("int")


def frequency_rate(code: Column) -> Column:
    """Times per day meant by an answer-frequency code.

    The hundreds digit names the period and the last two digits the count. Codes
    outside the three periods, and a count of zero, have no rate.
    """
    number = to_number(code)
    whole = F.when(number == F.floor(number), number.try_cast("int"))
    period = F.floor(whole / 100).cast("int")
    count = whole % 100
    rate = F.lit(None).cast("double")
    for digit, days in FREQUENCY_DAYS.items():
        rate = F.when(period == digit, count.cast("double") / days).otherwise(rate)
    return F.when(count > 0, rate)
