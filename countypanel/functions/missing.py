"""Missing values, numbers in text, zero padding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field texts that stand for "missing" in a delimited file.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

BLANKS = " \t\r\n\f\v"


def text_or_null(col: Column) -> Column:
    """The field as read, or NULL when it is one of the missing-value texts."""
    return F.when(~col.isin(NULL_TOKENS), col)


def clean_missing(df: DataFrame) -> DataFrame:
    """Missing-value texts of string columns and NaN of float columns become NULL.

    Later steps can then rely on NULL alone; NaN would compare as the largest value
    and poison averages.
    """
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            col = text_or_null(col)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(field.name))
    return df.select(*out)


def to_number(col: Column) -> Column:
    """Number held in a text, NULL when the text is not a plain decimal number.

    Texts only the JVM reads as numbers ("1d", "0x1p3"), the spellings of NaN and
    infinity, and numbers beyond the range of a double count as missing. No pattern is
    matched, as this runs on every observation.
    """
    text = col.cast("string")
    number = text.try_cast("double")
    last = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
    plain = (last.between("0", "9") | (last == ".")) & (F.instr(F.lower(text), "x") == 0)
    return F.when(plain & (F.abs(number) < float("inf")), number)


def zero_pad(col: Column, width: int) -> Column:
    """Left-pad with zeros. Unlike lpad it never cuts a longer text."""
    return F.when(F.length(col) >= width, col).otherwise(F.lpad(col, width, "0"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL for a zero or missing whole."""
    return F.try_divide(part, whole)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part, whole)


def flag(condition: Column) -> Column:
    """1 or 0; an unknown comparison counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))
