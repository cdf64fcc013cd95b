"""Labour tables, the merged panel and what is drawn from it."""

import math

import pytest
from pyspark.sql import functions as F

from countypanel.operators import labor, panel, regression

AREA = "area_type_code string, area_code string, area_text string"
SERIES = "series_id string, area_type_code string, area_code string, measure_code string, seasonal string"
DATA = "series_id string, year string, period string, value string, footnote_codes string"


@pytest.fixture
def lookups(rows):
    area = rows([
        ("A", "ST0600000000000", "California"),
        ("F", "CN0600100000000", "Alameda County, CA"),
        ("F", "CN2616300000000", "Wayne County, MI"),
        ("G", "CT0600562000000", "Alameda city, CA"),
    ], AREA)
    series = rows(
        [("series_id", "area_type_code", "area_code", "measure_code", "seasonal")]
        + [(f"L{a}{m}", "F", a, m, "U") for a in ("CN0600100000000", "CN2616300000000", "CT0600562000000")
           for m in ("03", "04", "05", "06")], SERIES)
    return area, series


@pytest.fixture
def data(rows):
    a, w = "LCN0600100000000", "LCN2616300000000"
    return rows([
        ("series_id", "year", "period", "value", "footnote_codes"),
        (a + "03", "2000", "M01", " 5.0", None),
        (a + "03", "2000", "M01", "7.0", None),
        (a + "04", "2000", "M01", "100", None),
        (a + "03", "2000", "M02", "-", None),
        (a + "03", "2000", "M13", "9.0", None),
        (a + "05", "2000", "Mxx", "1", None),
        (w + "06", "2000", "M01", "4", None),
        ("LCT060056200000003", "2000", "M01", "1", None),
    ], DATA)


def test_county_areas(lookups):
    area, _ = lookups
    assert [r.state_fips for r in labor.county_areas(area).orderBy("area_code").collect()] == ["06", "26"]
    assert [r.area_text for r in labor.county_areas(area, "26").collect()] == ["Wayne County, MI"]


def test_series_of_counties_drops_header_and_cities(lookups):
    area, series = lookups
    assert labor.series_of(series, labor.county_areas(area)).count() == 8


def wide(lookups, data, **options):
    area, series = lookups
    counties = labor.county_areas(area)
    months = labor.labor_wide(data, labor.series_of(series, counties), counties, **options)
    return months, {(r.county, r.month): r for r in months.collect()}


def test_months(lookups, data):
    _, got = wide(lookups, data)
    assert set(got) == {("Alameda County, CA", 1), ("Alameda County, CA", 13), ("Wayne County, MI", 1)}
    first = got[("Alameda County, CA", 1)]
    assert (first.unemployment_rate, first.labor_force, first.employment) == (6.0, 100.0, None)
    _, got = wide(lookups, data, annual_period="drop")
    assert ("Alameda County, CA", 13) not in got
    with pytest.raises(ValueError):
        wide(lookups, data, annual_period="no")


def test_months_equal_the_mean_of_typed_rows(lookups, data):
    area, series = lookups
    counties = labor.county_areas(area)
    typed = labor.typed(labor.labor_star(data, labor.series_of(series, counties), counties))
    plain = {
        (r.county, r.month, r.measure_code): r.v
        for r in typed.where("month is not null").groupBy("county", "month", "measure_code")
        .agg(F.avg("value").alias("v")).collect()
    }
    _, got = wide(lookups, data)
    for (county, month, code), value in plain.items():
        if value is not None:
            assert got[(county, month)][labor.MEASURES[code]] == pytest.approx(value)


def test_further_measures(lookups, data):
    months, _ = wide(lookups, data, measures={"03": "rate"})
    assert months.columns[-1] == "rate"


def test_yearly(lookups, data):
    months, _ = wide(lookups, data)
    yearly = {r.county_name: r for r in labor.labor_yearly(months).collect()}
    a = yearly["Alameda County, CA"]
    assert (a.unemployment_rate_mean, a.unemployment_rate_min, a.unemployment_rate_max) == (7.5, 6.0, 9.0)
    assert a.employment_mean is None


PANEL = "state_name string, county_name string, survey_year int, x double, y double"


@pytest.fixture
def small_panel(rows):
    return rows([
        ("S", "a", 2000, 1.0, 10.0), ("S", "b", 2000, 2.0, 20.0), ("S", "c", 2000, 2.0, None),
        ("S", "d", 2000, None, 5.0), ("S", "e", 2000, 9.0, 7.0), ("S", "f", 2000, 8.0, 8.0),
        ("S", "g", 2000, 7.0, 9.0), ("S", "h", 2000, 6.0, 9.5), ("S", "a", 2001, 4.0, 1.0),
    ], PANEL)


def test_extremes(small_panel):
    got = panel.extreme_counties(small_panel.where("survey_year = 2000"), 2, "x", "y")
    marks = {r.county_name: tuple(r)[-4:] for r in got.collect()}
    # top x: e, f; low x: a, then b before c on a tie; top y: b, a; low y: d, e.
    assert marks == {
        "a": (False, True, True, False), "b": (False, True, True, False),
        "d": (False, False, False, True), "e": (True, False, False, True),
        "f": (True, False, False, False),
    }


def test_extremes_take_missing_values_last(rows):
    df = rows([("S", "a", 1, None, 1.0), ("S", "b", 1, 1.0, None)], PANEL)
    got = {r.county_name: (r.top_x, r.low_x, r.top_y, r.low_y)
           for r in panel.extreme_counties(df, 1, "x", "y").collect()}
    assert got == {"a": (False, False, True, True), "b": (True, True, False, False)}


def test_order_and_matrix(small_panel):
    order = [(r.position, r.county_name) for r in panel.county_order(small_panel, "x").collect()]
    assert order[:3] == [(1, "e"), (2, "f"), (3, "g")]
    assert [c for _, c in order][-4:] == ["a", "b", "c", "d"]
    matrix = panel.county_year_matrix(small_panel, "y", None, "x").collect()
    assert matrix[0].asDict().keys() == {"state_name", "position", "county_name", "y2000", "y2001"}
    by_county = {r.county_name: (r.position, r.y2000, r.y2001) for r in matrix}
    assert "c" not in by_county
    assert by_county["a"] == (5, 10.0, 1.0)


def test_trend_counts_each_county_once(small_panel):
    got = {r.survey_year: (r.x, r.y) for r in panel.mean_by_year(small_panel, ["x", "y"]).collect()}
    assert got[2000][0] == pytest.approx(35 / 7)
    assert got[2001] == (4.0, 1.0)


def test_grouped_answers(rows):
    labels = ["Excellent", "Very good", "Good", "Fair", "Poor"]
    schema = "state_name string, survey_year int, " + ", ".join(
        f"`general_health_status_{h}_w` double" for h in labels)
    df = rows([("S", 2000, 10.0, 20.0, 30.0, 25.0, 15.0), ("S", 2000, 0.0, 0.0, 100.0, 0.0, 0.0)], schema)
    got = panel.collapsed_health(df).first()
    assert (got.above_good, got.good, got.below_good) == (15.0, 65.0, 20.0)


LONG = ("state_name string, fips string, survey_year int, variable string, category string, "
        "weighted_percent double")


def test_expected_rate(rows):
    labor_years = rows([("a", 2000), ("b", 2000), ("a", 2001), ("a", 2002)],
                       "fips string, survey_year int")
    long = rows([
        ("S", "a", 2000, "eats_fruit", "101.0", 50.0), ("S", "a", 2000, "eats_fruit", "207.0", 50.0),
        ("S", "b", 2000, "eats_fruit", "102.0", 40.0), ("S", "b", 2000, "eats_fruit", "555.0", 60.0),
        ("S", "z", 2000, "eats_fruit", "199.0", 100.0),
        ("S", "a", 2001, "other", "1.0", 100.0),
        ("S", "a", 2002, "eats_fruit", "555.0", 100.0),
    ], LONG)
    got = {r.survey_year: r.expected_per_day for r in panel.expected_rate(long, labor_years).collect()}
    # Over two counties: 25 % once a day, 25 % seven a week, 20 % twice a day.
    assert got[2000] == pytest.approx(0.25 + 0.25 + 0.4)
    assert got[2001] is None and got[2002] is None


def test_expected_rate_of_proportions(rows):
    labor_years = rows([("a", 2000)], "fips string, survey_year int")
    long = rows([("S", "a", 2000, "eats_fruit", "103.0", 0.5)], LONG)
    assert panel.expected_rate(long, labor_years).first().expected_per_day == pytest.approx(1.5)


def test_merge_keeps_common_county_years(rows):
    shares = rows([("a", 2000, 1.0), ("b", 2000, 2.0)], "fips string, survey_year int, s double")
    yearly = rows([("a", 2000, 3.0), ("a", 2001, 4.0)], "fips string, survey_year int, l double")
    assert [tuple(r) for r in panel.merge_panel(shares, yearly).collect()] == [("a", 2000, 1.0, 3.0)]
    named = [t.withColumnRenamed("fips", "county_name") for t in (shares, yearly)]
    assert panel.merge_panel(*named, panel.PLACE_TIME).count() == 1


def test_change_and_correlations(small_panel):
    change = {(r.county_name, r.survey_year): r.change
              for r in panel.yearly_change(small_panel, "x", place=("county_name",)).collect()}
    assert change[("a", 2000)] is None and change[("a", 2001)] == 3.0
    pairs = panel.correlations(small_panel.withColumn("z", -F.col("x")), ["x", "z"]).collect()
    assert [(r.a, r.b) for r in pairs] == [("x", "z")] and pairs[0].r == pytest.approx(-1.0)
    flat = panel.correlations(small_panel.withColumn("z", F.lit(1.0)), ["x", "z"]).collect()
    assert flat[0].r is None


def line(rows):
    points = [(1.0, 2.1), (2.0, 3.9), (3.0, 6.2), (4.0, 7.8), (5.0, 10.1), (6.0, 11.7)]
    return rows([("S", x, y) for x, y in points] + [("S", 3.0, None), ("T", 1.0, 1.0), ("T", 1.0, 2.0)],
                "state_name string, x double, y double")


def test_fit(rows):
    import numpy as np

    df = line(rows)
    fits = {r.state_name: r for r in regression.fit_lines(df, ["y"], "x").collect()}
    x = np.arange(1.0, 7.0)
    y = np.array([2.1, 3.9, 6.2, 7.8, 10.1, 11.7])
    slope, intercept = np.polyfit(x, y, 1)
    assert fits["S"].n == 6
    assert fits["S"].slope == pytest.approx(slope) and fits["S"].intercept == pytest.approx(intercept)
    assert fits["T"].slope is None
    rss = ((y - slope * x - intercept) ** 2).sum()
    got = {r.state_name: r for r in regression.fit_summary(
        regression.fit_lines(df, ["y"], "x")).collect()}
    s = got["S"]
    assert s.se_slope == pytest.approx(np.sqrt(rss / 4 / 17.5))
    assert s.f_value == pytest.approx(s.t_slope ** 2)
    loglik = -3 * (np.log(2 * np.pi) + np.log(rss / 6) + 1)
    assert s.loglik == pytest.approx(loglik) and s.aic == pytest.approx(4 - 2 * loglik)
    assert s.bic == pytest.approx(2 * np.log(6) - 2 * loglik)
    assert got["T"].se_slope is None and got["T"].loglik is None


def test_p_values_agree_with_the_ml_library(rows):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = line(rows).where("state_name = 'S' and y is not null")
    mine = regression.p_values(regression.fit_lines(df, ["y"], "x")).first()
    points = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    fit = LinearRegression(labelCol="y", solver="normal").fit(points).summary
    assert mine.p_slope == pytest.approx(fit.pValues[0], abs=1e-12)
    assert mine.p_intercept == pytest.approx(fit.pValues[1], abs=1e-9)
    assert mine.t_slope == pytest.approx(fit.tValues[0])


@pytest.mark.parametrize("t, free, p", [
    (12.706204736, 1, 0.05), (4.302652730, 2, 0.05), (3.182446305, 3, 0.05), (2.776445105, 4, 0.05),
    (2.228138852, 10, 0.05), (2.042272456, 30, 0.05), (0.0, 7, 1.0), (-2.570581836, 5, 0.05),
])
def test_student_tail(spark, t, free, p):
    got = spark.range(1).select(regression.two_sided_p(F.lit(t), F.lit(free))).first()[0]
    assert got == pytest.approx(p, abs=1e-9)


def test_small_tails_keep_their_digits(spark):
    """Against the closed forms for one and two degrees of freedom."""
    got = spark.range(1).select(
        regression.two_sided_p(F.lit(1e6), F.lit(1)), regression.two_sided_p(F.lit(1e5), F.lit(2)),
        regression.two_sided_p(F.lit(30.0), F.lit(40)), regression.two_sided_p(F.lit(None).cast("double"), F.lit(4)),
        regression.two_sided_p(F.lit(1.0), F.lit(0))).first()
    assert got[0] == pytest.approx(2 / math.pi * math.atan(1e-6), rel=1e-9)
    assert got[1] == pytest.approx(1e-10, rel=1e-6)
    assert 0 < got[2] < 1e-25 and got[3] is None and got[4] is None
