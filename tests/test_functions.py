"""Column functions against values worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from countypanel.functions import codes, formats, missing, names


def column(df, col):
    return [r[0] for r in df.select(col).collect()]


def texts(rows, values):
    return rows([(v,) for v in values], "c string")


def test_missing_texts_become_null(rows):
    df = texts(rows, ["", "NA", "nan", "None", "null", "N/A", "#N/A", "na", " NA", "0", "x", None])
    got = [r.c for r in missing.clean_missing(df).collect()]
    assert got == [None] * 7 + ["na", " NA", "0", "x", None]


def test_nan_becomes_null(rows):
    df = rows([(float("nan"),), (1.5,), (None,)], "v double")
    assert [r.v for r in missing.clean_missing(df).collect()] == [None, 1.5, None]


def test_numbers_in_text(rows):
    df = texts(rows, [" 5.0", "-", "", "1e2", "-.5", "+3", "1d", "0x10", "NaN", "inf", "1.2.3", None])
    assert column(df, missing.to_number(F.col("c"))) == [
        5.0, None, None, 100.0, -0.5, 3.0, None, None, None, None, None, None]


def test_padding_never_cuts(rows):
    df = texts(rows, ["6", "12345", "", None])
    assert column(df, missing.zero_pad(F.col("c"), 3)) == ["006", "12345", "000", None]


def test_ratio_of_zero_is_null(rows):
    df = rows([(1.0, 0.0), (0.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert column(df, missing.ratio(F.col("a"), F.col("b"))) == [None, None, 0.25]


def test_flag_of_unknown_is_zero(rows):
    df = rows([(1.0,), (9.0,), (None,)], "v double")
    assert column(df, missing.flag(F.col("v") > 5)) == [0, 1, 0]


def test_strict_codes(rows):
    df = texts(rows, ["6.0", "6", " 26", "6.5", "x", None])
    assert column(df, codes.integer_code(F.col("c"), 2)) == ["06", "06", "26", None, None, None]


def test_lenient_codes(rows):
    df = texts(rows, ["6.0", "6", "a17b3", "x", "", "777.0", None])
    assert column(df, codes.digits_code(F.col("c"), 3)) == [
        "006", "006", "017", "000", "000", "777", "000"]


def test_joined_codes_may_be_short(rows):
    df = rows([("06", "001"), (None, "001"), ("06", None), (None, None)], "s string, c string")
    assert column(df, codes.join_codes(F.col("s"), F.col("c"))) == ["06001", "001", "06", ""]


def test_answer_labels(rows):
    assert column(texts(rows, ["1", "101.0", "Yes", None]), codes.answer_label(F.col("c"))) == [
        "1.0", "101.0", "Yes", None]
    numbers = rows([(1.0,), (101.0,), (None,)], "v double")
    assert column(numbers, codes.answer_label(F.col("v"))) == ["1.0", "101.0", None]


def test_month_of_period(rows):
    assert column(texts(rows, ["M01", "M13", "S0x", None]), codes.month_of_period(F.col("c"))) == [
        1, 13, None, None]


@pytest.mark.parametrize("code, rate", [
    (100, None), (101, 1.0), (199, 99.0), (200, None), (207, 1.0), (299, 99 / 7), (300, None),
    (330, 1.0), (399, 3.3), (400, None), (555, None), (777, None), (999, None), (1, None), (2, None),
])
def test_frequency_rate(rows, code, rate):
    got = column(texts(rows, [f"{code}.0"]), codes.frequency_rate(F.col("c")))[0]
    assert got is None if rate is None else math.isclose(got, rate)


def test_frequency_rate_of_other_texts(rows):
    df = texts(rows, ["101.5", "Yes", None])
    assert column(df, codes.frequency_rate(F.col("c"))) == [None, None, None]


def test_display_key(rows):
    df = rows([(" Alameda County", "California "), ("Juneau", "Alaska"), (None, "Ohio")],
              "c string, s string")
    key = names.display_key(F.col("c"), F.col("s"))
    assert column(df, key) == ["Alameda County, CA", "Juneau, AK", None]
    prefix = names.display_key(F.col("c"), F.col("s"), "prefix2")
    assert column(df, prefix) == ["Alameda County, CA", "Juneau, AL", None]
    elsewhere = rows([("Kent", "Old England")], "c string, s string")
    assert column(elsewhere, names.display_key(F.col("c"), F.col("s"))) == ["Kent, Old England"]
    with pytest.raises(ValueError):
        names.state_abbreviation(F.col("s"), "other")


NAME_CASES = {
    "Alameda County, CA": "alameda",
    "San Francisco County, California": "san francisco",
    "City and County of San Francisco": "san francisco",
    "St. Clair County": "saint clair",
    "St Clair": "saint clair",
    "Stanislaus County": "stanislaus",
    "A & B  County": "a and b",
    "Lake County, California, CA": "lake california",
    None: "",
}


def test_name_key(rows):
    df = texts(rows, list(NAME_CASES))
    assert column(df, names.name_key(F.col("c"), "California", "CA")) == [
        "alameda", "san francisco", "san francisco", "saint clair", "saint clair", "stanislaus",
        "a and b", "lake california", ""]


def test_name_key_with_state_columns(rows):
    df = rows([("Wayne County, Michigan", "Michigan", "MI"), ("Kern County, CA", "California", "CA"),
               ("X (a+b), N.Y.", "New York", "N.Y.")], "c string, s string, a string")
    assert column(df, names.name_key(F.col("c"), F.col("s"), F.col("a"))) == ["wayne", "kern", "x a b"]


def test_suffix_is_literal(rows):
    df = texts(rows, ["Kern County, CA", "Kern County. CA"])
    assert column(df, names.strip_suffix_text(F.col("c"), " County, CA")) == ["Kern", "Kern County. CA"]


def test_rounding_ties_go_to_even(rows):
    df = rows([(2.25,), (0.35,), (66.65,), (2.35,)], "v double")
    assert column(df, formats.one_decimal(F.col("v"))) == [2.2, 0.4, 66.6, 2.4]


def test_texts_of_numbers(rows):
    df = rows([(12345, 3, 8), (1234567, 0, 0)], "m long, a long, b long")
    assert column(df, formats.money(F.col("m"))) == ["$12,345", "$1,234,567"]
    assert df.limit(1).select(formats.matched_of_total(F.col("a"), F.col("b"))).first()[0] == "3/8 (37.5%)"


def test_odd_numbers_stop_nothing(rows):
    texts = ["9999999999", "1e999", "-1e999", "1d", "0x1p3", "5.", ".5", " 7 ", "1e5", "nan", "Infinity", "", "12f", "1e30"]
    df = rows([(t,) for t in texts], "t string")
    assert column(df, missing.to_number(F.col("t"))) == [
        9999999999.0, None, None, None, None, 5.0, 0.5, 7.0, 100000.0, None, None, None, None, 1e30]
    assert column(df, codes.frequency_rate(F.col("t"))) == [None] * len(texts)
    assert column(df, codes.integer_code(F.col("t"), 3))[-1] is None


def test_ties_of_noisy_means(rows):
    df = rows([(22.65,), (22.650000000000002,), (22.649999999999995,), (22.75,), (None,)], "m double")
    assert column(df, formats.one_decimal(F.col("m"))) == [22.6, 22.6, 22.6, 22.8, None]
