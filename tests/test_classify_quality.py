"""Classes, their agreement, map tables and quality reports."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from countypanel.operators import classify, quality

PANEL = "state_name string, county_name string, survey_year int, x double, y double"
INCOME = "state_name string, survey_year int, county_key string, median_income double"


def test_quadrants(rows):
    df = rows([("S", "a", 1, 1.0, 40.0), ("S", "b", 1, 2.0, 30.0), ("S", "c", 1, 3.0, 20.0),
               ("S", "d", 1, 4.0, 10.0), ("S", "e", 1, None, None), ("T", "a", 1, 5.0, 5.0)], PANEL)
    got = {(r.state_name, r.county_name): r for r in classify.quadrants(df, "x", "y").collect()}
    assert [(got[("S", c)].u_bin, got[("S", c)].h_bin) for c in "abcde"] == [
        (0, 0), (0, 0), (1, 1), (1, 1), (0, 0)]
    assert got[("S", "a")].color == "#2ca25f" and got[("S", "d")].color == "#d73027"
    assert got[("S", "c")].quadrant == "High unemployment + Low % Excellent Health"
    # A value on the median is not above it, and counts as low health.
    assert (got[("T", "a")].u_bin, got[("T", "a")].h_bin) == (0, 1)
    cuts = {r.state_name: (r.x_cut, r.y_cut) for r in classify.cutoffs(df, "x", "y").collect()}
    assert cuts["S"] == (2.5, 25.0)


@pytest.mark.parametrize("values", [
    list(range(58)), [5, 5, 5, 1, 2, 9, 9], list(range(83)), [1, 2, 3], [3, 1, 2, 2, 2, 2, 8, 9, 10, 11],
])
def test_tertiles_follow_interpolated_edges(rows, values):
    df = rows([("S", 2000, str(i), float(v)) for i, v in enumerate(values)] + [("T", 2000, "0", 1e9)], INCOME)
    low, high = np.quantile(np.array(values, dtype=float), [1 / 3, 2 / 3])
    expected = ["Low" if v <= low else "Middle" if v <= high else "High" for v in values]
    got = {int(r.county_key): r.income_bracket for r in classify.income_tertiles(df).where("state_name = 'S'").collect()}
    assert [got[i] for i in range(len(values))] == expected


def test_tertiles_of_few_values(rows):
    df = rows([("S", *row) for row in (
        (1, "a", 1.0), (1, "b", 2.0), (1, "c", 1.0), (2, "a", 7.0), (2, "b", 7.0),
        (3, "a", None), (4, "a", 1.0), (4, "b", 1.0), (4, "c", 2.0), (4, "d", 9.0))], INCOME)
    got = {(r.survey_year, r.county_key): r.income_bracket for r in classify.income_tertiles(df).collect()}
    assert [got[(1, c)] for c in "abc"] == ["Low", "High", "Low"]
    assert got[(2, "a")] == got[(2, "b")] == "Middle"
    assert (3, "a") not in got
    ties = rows([("S", 5, c, v) for c, v in zip("abcdefg", [1.0, 2.0, 2.0, 2.0, 2.0, 2.0, 3.0])], INCOME)
    assert [r.survey_year for r in classify.coinciding_edges(df.union(ties)).collect()] == [5]


def test_median_text(rows):
    df = rows([("S", 1, "a", 1000.0), ("S", 1, "b", 2000.0), ("S", 1, "c", None)], INCOME)
    assert tuple(classify.area_median(df).first()) == ("S", 1, 1500.0, "$1,500")


def test_first_by_key(rows):
    df = rows([("k", "b", 1), ("k", "a", 2), ("m", "z", 3)], "k string, name string, v int")
    got = {tuple(r) for r in classify.first_by_key(df, ["k"], ["name"]).collect()}
    assert got == {("k", "a", 2), ("m", "z", 3)}


def test_agreement(rows):
    q = {k: v[0] for k, v in classify.QUADRANTS.items()}
    cases = [("High", (0, 0), "Green ↔ Green"), ("Low", (1, 1), "Red ↔ Red"),
             ("Middle", (0, 1), "Middle ↔ Teal"), ("Middle", (1, 0), "Middle ↔ Yellow"),
             ("Low", (0, 0), "Mismatch"), ("High", (1, 1), "Mismatch"), ("Middle", (0, 0), "Mismatch")]
    df = rows([("S", 2005, b, q[p], e) for b, p, e in cases],
              "state_name string, survey_year int, income_bracket string, quadrant string, expected string")
    assert all(r.alignment == r.expected for r in classify.with_agreement(df).collect())
    by_year = {r.alignment: (r["count"], r.percent) for r in classify.agreement_by_year(df).collect()}
    assert by_year["Mismatch"] == (3, 42.9) and by_year["Red ↔ Red"] == (1, 14.3)
    wide = classify.agreement_wide(classify.agreement_by_year(df.where("expected = 'Mismatch'"))).first()
    assert wide.asDict() == {"state_name": "S", "survey_year": 2005, "Green ↔ Green": 0.0, "Middle ↔ Teal": 0.0,
                             "Middle ↔ Yellow": 0.0, "Red ↔ Red": 0.0, "Mismatch": 100.0}


def test_matching_by_name_key(rows):
    classes = rows([("California", 2005, "St. Clair County, CA", "first"), ("California", 2005, "St Clair, CA", "second"),
                    ("California", 2005, "Kern County, CA", "k")],
                   "state_name string, survey_year int, county_name string, quadrant string")
    incomes = rows([("California", 2005, "saint clair", "Low"), ("California", 2006, "kern", "High")],
                   "state_name string, survey_year int, county_key string, income_bracket string")
    got = classify.matching_classes(classes, incomes, F.col("state_name"), "CA").collect()
    assert [(r.county_key, r.quadrant, r.income_bracket) for r in got] == [("saint clair", "second", "Low")]


def test_counties_of_one_name_keep_their_state(rows):
    classes = rows([("Michigan", 2005, "Jackson County, MI", "m"), ("Ohio", 2005, "Jackson County, OH", "o")],
                   "state_name string, survey_year int, county_name string, quadrant string")
    incomes = rows([("Michigan", 2005, "jackson", "Low"), ("Ohio", 2005, "jackson", "High")],
                   "state_name string, survey_year int, county_key string, income_bracket string")
    short = F.when(F.col("state_name") == "Ohio", "OH").otherwise("MI")
    got = classify.matching_classes(classes, incomes, F.col("state_name"), short).collect()
    assert {(r.state_name, r.quadrant, r.income_bracket) for r in got} == {("Michigan", "m", "Low"), ("Ohio", "o", "High")}
    features = rows([("Michigan", "Jackson"), ("Ohio", "Jackson")], "state_name string, feature_name string")
    mapped = classify.tertile_map(
        features, incomes.withColumn("median_income", F.lit(1.0)), [2005], F.col("state_name"), short).collect()
    assert {(r.state_name, r.mhi_bracket) for r in mapped} == {("Michigan", "Low"), ("Ohio", "High")}


def test_common_years(rows):
    a = rows([(2004,), (2005,), (2006,), (2006,)], "survey_year int")
    b = rows([(2004,), (2006,), (2011,)], "survey_year int")
    assert [r[0] for r in classify.common_years(a, b, 2005, 2010).collect()] == [2006]


def test_quadrant_map(rows):
    classes = rows([("California", "Kern County, CA", 2010, 9.250000000000002, 20.04, "q", "#1")],
                   "state_name string, county_name string, survey_year int, x double, y double, quadrant string, color string")
    features = rows([("California", "Kern"), ("California", "Inyo")], "state_name string, feature_name string")
    got = {(r.feature_name, r.survey_year): r for r in classify.quadrant_map(
        features, classes, [2010, 2011], x="x", y="y").collect()}
    assert len(got) == 4
    kern, inyo = got[("Kern", 2010)], got[("Inyo", 2010)]
    assert (kern.color, kern.quadrant, kern.unemp_pct, kern.excellent_pct) == ("#1", "q", 9.2, 20.0)
    assert (inyo.color, inyo.quadrant, inyo.unemp_pct) == ("#000000", "No data", None)


def test_tertile_map_and_its_match_count(rows):
    brackets = rows([("California", 2010, "kern", 45678.9, "Low")],
                    "state_name string, survey_year int, county_key string, median_income double, income_bracket string")
    features = rows([("California", "Kern County"), ("California", "Inyo")], "state_name string, feature_name string")
    mapped = classify.tertile_map(features, brackets, [2010], "California", "CA")
    got = {r.feature_name: r for r in mapped.collect()}
    assert tuple(got["Kern County"])[4:] == (45678, "$45,678", "Low", "#d73027")
    assert tuple(got["Inyo"])[4:] == (None, "No data", "No data", "#000000")
    assert quality.map_match_rate(mapped).first().match_text == "1/2 (50.0%)"


SURVEY = "_state string, ctycode string, survey_year int"
CROSSWALK = "fips string, state_name string, county_name string"


def test_match_rate_and_profile(rows):
    raw = rows([("6", "1.0", 2000), ("6", "777", 2000), ("6", None, 2000), ("06", "001", 2000),
                ("26", "000", 2001)], SURVEY)
    crosswalk = rows([("06001", "California", "Alameda County")], CROSSWALK)
    got = quality.match_rate(raw, crosswalk).collect()
    assert [(r.survey_year, r.matched, r.total, r.match_text) for r in got] == [(2000, 2, 3, "2/3 (66.7%)")]
    profile = {r.state_fips: r for r in quality.key_profile(raw).collect()}
    assert (profile["06"].rows, profile["06"].county_codes, profile["06"].placeholder_rows) == (4, 3, 1)
    assert (profile["26"].first_year, profile["26"].last_year) == (2001, 2001)


def test_run_summary(rows):
    years = lambda *y: rows([(v,) for v in y], "survey_year int")
    available = rows([(2000, None, 9), (2001, 6, 7)], "survey_year int, rows long, cols int")
    got = {r.survey_year: tuple(r)[1:] for r in quality.run_summary(
        years(1999, 2000, 2001), available, years(2000)).collect()}
    assert got == {1999: ("not_found", None, None), 2000: ("skipped_existing", None, None),
                   2001: ("ok", 6, 7)}


def test_empty_partitions_and_gaps(rows):
    states = rows([("CA",), ("CA",)], "state_name string")
    counts = lambda *v: rows(list(v), "state_name string, survey_year int, rows long")
    got = {r.survey_year: r.status for r in quality.empty_partitions(
        states, counts(("CA", 2000, 3), ("CA", 2001, 1)), counts(("CA", 2000, 3), ("CA", 2002, 1)),
        2000, 2003).collect()}
    assert got == {2000: "ok", 2001: "no labor rows", 2002: "no survey rows", 2003: "empty"}
    counties = rows([("x", "CA", "A, CA")], CROSSWALK)
    panel = rows([("x", 2000), ("y", 2001)], "fips string, survey_year int")
    gaps = quality.coverage_gaps(counties, panel, 2000, 2001).collect()
    assert [tuple(r) for r in gaps] == [("x", "CA", "A, CA", 2001)]


def test_bad_values(rows):
    df = rows([("1", "x"), ("-", None), (None, "2")], "a string, b string")
    got = {r["column"]: (r.present, r.bad) for r in quality.bad_values(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 1), "b": (2, 1)}
