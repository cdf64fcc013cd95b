"""Time alignment, difference maps, several regressors, effects and phases against plain Python."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from countypanel.operators import alignment, linear, panel, phases


def gapped(seed, counties=9, years=range(1995, 2006)):
    """(fips, state_name, county_name, survey_year, x, y) with years that counties miss and values that are missing."""
    r = random.Random(seed)
    out = []
    for c in range(counties):
        for year in years:
            if r.random() < 0.75:
                x = None if r.random() < 0.1 else r.gauss(0, 2) + year % 4
                out.append((f"{c:05d}", "AB"[c % 2], f"c{c} County", year, x, None if r.random() < 0.1 else r.gauss(c, 1)))
    return out


GAPPED = "fips string, state_name string, county_name string, survey_year int, x double, y double"


def test_lags_pair_exact_years(rows):
    data = gapped(1)
    df = rows(data, GAPPED).withColumn("lag", F.lit("clash"))
    got = {(r.state_name, r.lag): r for r in alignment.lagged_correlation(df, ["y"], "x").collect()}
    assert len(got) == 2 * 7
    for (state, lag), r in got.items():
        at = {(f, year): y for f, s, _, year, _, y in data if s == state}
        pairs = [(x, at[f, year + lag]) for f, s, _, year, x, _ in data
                 if s == state and x is not None and at.get((f, year + lag)) is not None]
        want = np.corrcoef(*zip(*pairs))[0, 1]
        assert r.n == len(pairs) and r.r == pytest.approx(want) and r.t == pytest.approx(want * math.sqrt((len(pairs) - 2) / (1 - want**2)))
        assert 0 <= r.p <= 1
    best = {r.state_name: r.lag for r in alignment.best_lag(alignment.lagged_correlation(df, ["y"], "x")).collect()}
    for state in "AB":
        assert best[state] == min(range(-3, 4), key=lambda k: (-round(abs(got[state, k].r), 9), abs(k), -k))


def test_outcome_that_follows_is_found_at_its_lag(rows):
    r = random.Random(2)
    data = []
    for c in range(4):
        x = [r.gauss(0, 1) for _ in range(20)]
        data += [(f"{c:05d}", "A", f"c{c}", 1990 + i, x[i], x[i - 2] if i >= 2 else None) for i in range(20) if (c + i) % 7]
    got = alignment.best_lag(alignment.lagged_correlation(rows(data, GAPPED), ["y"], "x")).collect()
    assert [(g.outcome, g.lag) for g in got] == [("y", 2)] and got[0].r == pytest.approx(1)


def test_lags_without_pairs_or_spread(rows):
    flat = [("1", "A", "a", 2000 + i, 5.0, float(i)) for i in range(4)] + [("2", "B", "b", 2000, 1.0, 1.0)]
    got = {(r.state_name, r.lag): r for r in alignment.lagged_correlation(rows(flat, GAPPED), ["y"], "x").collect()}
    assert got["A", 0].n == 4 and got["A", 0].r is None and got["B", 0].n == 1 and got["B", 0].r is None and got["B", 2].n == 0
    line = alignment.lagged_correlation(rows([("1", "A", "a", 2000 + i, float(i), 2.0 * i) for i in range(5)], GAPPED), ["y"], "x", lags=(0,)).first()
    assert line.r == pytest.approx(1) and line.t is None and line.p is None
    assert alignment.lagged_correlation(rows([], GAPPED), ["y"], "x").count() == 0
    assert alignment.best_lag(alignment.lagged_correlation(rows([], GAPPED), ["y"], "x")).count() == 0


@pytest.mark.parametrize("tolerance", [0, 1, 3])
def test_nearest_year_from_both_sides(rows, tolerance):
    r = random.Random(tolerance)
    data = [(str(c), y, r.choice([None, float(y + c)])) for c in range(12) for y in range(1990, 2010) if r.random() < 0.4]
    wanted = [(str(c), y) for c in range(13) for y in (1988, 1995, 2000, 2011)]
    got = alignment.nearest_year(rows(data, "fips string, survey_year int, v double"), rows(wanted, "fips string, wanted_year int"), "v", tolerance)
    found = {(g.fips, g.wanted_year): (g.found_year, g.value) for g in got.collect()}
    assert len(found) == len(wanted)
    for c, y in wanted:
        near = [(abs(s - y), s, v) for f, s, v in data if f == c and v is not None and abs(s - y) <= tolerance]
        assert found[c, y] == (min(near)[1:] if near else (None, None))


def test_difference_map_with_gaps_and_unmatched_features(rows):
    data = rows([("1", "A", "up County", 2001, 0.0, 10.0), ("1", "A", "up County", 2009, 0.0, 14.0),
                 ("2", "A", "down County", 2000, 0.0, 5.0), ("2", "A", "down County", 2010, 0.0, 4.0),
                 ("3", "A", "same County", 2000, 0.0, 3.0), ("3", "A", "same County", 2010, 0.0, 3.0 + 1e-12),
                 ("4", "A", "half County", 2000, 0.0, 3.0), ("4", "A", "half County", 2005, 0.0, 3.0),
                 ("5", "A", "zero County", 2000, 0.0, 0.0), ("5", "A", "zero County", 2010, 0.0, 1.0),
                 ("6", "A", "none County", 2000, 0.0, None)], GAPPED)
    features = rows([("A", n) for n in ("up", "down", "same", "half", "zero", "none", "gone")] + [("B", "up")], "state_name string, feature_name string")
    changes = alignment.changes_between(data, "y", 2000, 2010)
    got = {(r.state_name, r.feature_name): r for r in alignment.difference_map(features, changes, F.lit(" County")).collect()}
    assert len(got) == 8
    assert {n: g["class"] for (s, n), g in got.items() if s == "A"} == {
        "up": "increase", "down": "decrease", "same": "no change", "half": "No data", "zero": "increase", "none": "No data", "gone": "No data"}
    up = got["A", "up"]
    assert (up.from_year, up.to_year, up.change, up.yearly, up.percent) == (2001, 2009, 4.0, 0.5, 40.0)
    assert got["A", "zero"].percent is None and got["B", "up"]["class"] == "No data" and got["A", "gone"].color == "#000000"
    close = alignment.changes_between(data, "y", 2004, 2006, tolerance=1).where("fips = '4'").first()
    assert (close.from_year, close.to_year, close.change) == (2005, 2005, None)


def test_yearly_change_needs_the_year_before(rows):
    data = [("1", "A", "a", 2000, 1.0, 0.0), ("1", "A", "a", 2002, 5.0, 0.0), ("1", "A", "a", 2003, 4.0, 0.0), ("2", "A", "a", 2001, 9.0, 0.0)]
    got = {(r.fips, r.survey_year): r.change for r in panel.yearly_change(rows(data, GAPPED), "x").collect()}
    assert got == {("1", 2000): None, ("1", 2002): None, ("1", 2003): -1.0, ("2", 2001): None}


def plane(n, seed, k=3, collinear=False):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, k)) * [1, 50, 0.01][:k] + [3, 1990, 0][:k]
    if collinear:
        x[:, -1] = 2 * x[:, 0] - 3 * x[:, 1] + 1
    y = 4 + x @ np.array([1.5, -0.2, 30])[:k] + r.normal(size=n)
    return x, y


def test_several_regressors_equal_least_squares(rows):
    x, y = plane(60, 1)
    data = [("S", *map(float, a), float(b), float(b) if i % 5 else None) for i, (a, b) in enumerate(zip(x, y))]
    data += [("S", None, 1.0, 1.0, 1.0, 1.0), ("S", 1.0, 1.0, 1.0, None, None)]
    got = {(r.outcome, r.term): r for r in linear.fit_planes(rows(data, "state_name string, a double, b double, c double, y double, z double"),
                                                             ["y", "z"], ["a", "b", "c"]).collect()}
    for outcome, kept in (("y", np.arange(60)), ("z", np.flatnonzero(np.arange(60) % 5))):
        design = np.column_stack([np.ones(len(kept)), x[kept]])
        beta, *_ = np.linalg.lstsq(design, y[kept], rcond=None)
        rest = y[kept] - design @ beta
        mse = rest @ rest / (len(kept) - 4)
        se = np.sqrt(mse * np.diag(np.linalg.inv(design.T @ design)))
        for i, term in enumerate(("intercept", "a", "b", "c")):
            g = got[outcome, term]
            assert g.n == len(kept) and g.coef == pytest.approx(beta[i], rel=1e-6) and g.se == pytest.approx(se[i], rel=1e-6)
            assert g.r2 == pytest.approx(1 - rest @ rest / ((y[kept] - y[kept].mean()) ** 2).sum())


def test_dependent_or_constant_regressors_have_no_coefficients(rows):
    kind = "state_name string, a double, b double, c double, y double"
    x, y = plane(30, 2, collinear=True)
    data = [("dependent", *map(float, a), float(b)) for a, b in zip(x, y)]
    data += [("constant", float(i), 7.0, float(i * i), float(i)) for i in range(9)]
    data += [("few", float(i), float(i**2), float(i**3), 1.0 * i) for i in range(3)]
    data += [("exact", float(i), float(i**2), float(i**3), 1.0 * i) for i in range(4)]
    got = linear.fit_planes(rows(data, kind), ["y"], ["a", "b", "c"]).collect()
    assert len(got) == 16
    for r in got:
        assert (r.coef is None) == (r.state_name != "exact") and r.se is None
    fine = linear.fit_planes(rows(data, kind).where("state_name = 'dependent'"), ["y"], ["a", "b"]).collect()
    assert all(r.coef is not None and r.se > 0 for r in fine)
    assert linear.fit_planes(rows([], kind), ["y"], ["a", "b"]).count() == 0


def dummies(data):
    """Least squares with a dummy for each place and year, and clustered errors."""
    places, years = sorted({d[0] for d in data}), sorted({d[1] for d in data})
    x = np.array([[*d[2:-1], *[d[0] == p for p in places], *[d[1] == y for y in years[1:]]] for d in data], dtype=float)
    y, k = np.array([d[-1] for d in data]), len(data[0]) - 3
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    rest, bread = y - x @ beta, np.linalg.pinv(x.T @ x)
    meat = sum(np.outer(s, s) for s in (x[[d[0] == p for d in data]].T @ rest[[d[0] == p for d in data]] for p in places))
    n, terms = len(data), k + len(places) + len(years) - 1
    scale = len(places) / (len(places) - 1) * (n - 1) / (n - terms)
    return beta[:k], np.sqrt(scale * np.diag(bread @ meat @ bread))[:k]


def test_effects_equal_dummies_on_an_unbalanced_panel(rows):
    r = random.Random(5)
    data = []
    for c in range(8):
        for year in range(1995, 2003):
            for _ in range(r.choice([0, 1, 1, 2])):
                a, b = r.gauss(c, 1), r.gauss(year % 5, 1)
                data.append((f"{c:05d}", year, a, b, 2 * a - b + 3 * c + 0.5 * year + r.gauss(0, 1)))
    kind = "fips string, survey_year int, a double, b double, y double"
    odd = [("00001", 1999, None, 1.0, 1.0), (None, 1999, 1.0, 1.0, 1.0), ("00001", 1999, 1.0, 1.0, None)]
    got = linear.fit_with_effects(rows(data + odd, kind).withColumn("n", F.lit("x")), "y", ["a", "b"]).collect()
    coef, se = dummies(data)
    assert [g.term for g in got] == ["a", "b"]
    for g, c, s in zip(got, coef, se):
        assert g.n == len(data) and g.coef == pytest.approx(c, rel=1e-7) and g.se == pytest.approx(s, rel=1e-7) and 0 <= g.p < 1


def test_effects_without_variation_or_rows(rows):
    kind = "fips string, survey_year int, a double, b double, y double"
    data = [(str(c), 2000 + i, 3.0 * c + i, float(c * i), float(c + i * i)) for c in range(4) for i in range(5)]
    assert [g.coef for g in linear.fit_with_effects(rows(data, kind), "y", ["a", "b"]).collect()] == [None, None]
    assert [g.coef for g in linear.fit_with_effects(rows([], kind), "y", ["a"]).collect()] == [None]


def brute_phases(values, least):
    """All cuts of the steps into alternating phases of at least `least` steps."""
    n = len(values) - 1
    best = None
    for turns in (t for k in range(n // least + 1) for t in itertools.combinations(range(1, n), k)):
        ends = [0, *turns, n]
        if turns and min(b - a for a, b in zip(ends, ends[1:])) < least:
            continue
        for first in (1, -1):
            score = sum(first * (-1) ** i * (values[b] - values[a]) for i, (a, b) in enumerate(zip(ends, ends[1:])))
            last = first * (-1) ** len(turns)
            key = (score, -len(turns), turns, last)
            if best is None or key > best[0]:
                best = (key, first)
    (_, _, turns, _), first = best
    ends = [0, *turns, n]
    return [(first * (-1) ** i, a, b) for i, (a, b) in enumerate(zip(ends, ends[1:]))]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_phases_equal_all_cuts(rows, least):
    r = random.Random(least)
    series = {f"p{k}": [r.choice(range(6)) + (r.random() if k % 2 else 0) for _ in range(r.randrange(2, 13))] for k in range(25)}
    data = [("county", p, 2000 + i // 12, i % 12 + 1, float(v)) for p, values in series.items() for i, v in enumerate(values)]
    got = {}
    for x in phases.downturn_phases(rows(data, "level string, place string, year int, month int, rate double"), least).orderBy("place", "phase").collect():
        begin, end = [(m // 100 - 2000) * 12 + m % 100 - 1 for m in (x.from_month, x.to_month)]
        got.setdefault(x.place, []).append((1 if x.direction == "rise" else -1, begin, end))
        assert x.months == end - begin and x.change == pytest.approx(round(series[x.place][end], 6) - round(series[x.place][begin], 6), abs=2e-6)
    for p, values in series.items():
        assert got[p] == brute_phases([round(v * 1_000_000) for v in values], least), values


def test_phases_of_gaps_repeats_and_short_series(rows):
    kind = "level string, place string, year int, month int, rate double"
    data = [("county", "a", 2000, 1, 3.0), ("county", "a", 2000, 4, None), ("county", "a", 2000, 9, 5.0), ("county", "a", 2000, 9, 7.0),
            ("county", "b", 2000, 1, 1.0), ("state", "a", 2000, 1, 2.0), ("state", "a", 2001, 1, 2.0)]
    got = {(r.level, r.place): r for r in phases.downturn_phases(rows(data, kind)).collect()}
    assert set(got) == {("county", "a"), ("state", "a")}
    assert (got["county", "a"].direction, got["county", "a"].change, got["county", "a"].turning_point) == ("rise", 3.0, None)
    assert got["state", "a"].direction == "rise" and got["state", "a"].change == 0
    assert phases.downturn_phases(rows([], kind)).count() == 0


def test_a_turn_may_cost(rows):
    values = [0, 5, 4, 9, 8, 12]
    data = rows([("county", "a", 2000, i + 1, float(v)) for i, v in enumerate(values)], "level string, place string, year int, month int, rate double")
    assert phases.downturn_phases(data, 1).count() == 5 and phases.downturn_phases(data, 1, least_swing=2.5).count() == 1


def test_state_rates_take_counties_with_both_numbers(rows):
    months = rows([("01001", "01", 2000, 1, 5.0, 100.0), ("01003", "01", 2000, 1, 15.0, 100.0), ("01005", "01", 2000, 1, 9.0, None),
                   ("01001", "01", 2000, 13, 99.0, 100.0)], "fips string, state_fips string, year int, month int, unemployment double, labor_force double")
    got = phases.state_rates(months, rows([("01", "Alabama")], "state_fips string, state_name string")).collect()
    assert [(r.level, r.place, r.year, r.month, r.rate) for r in got] == [("state", "Alabama", 2000, 1, 10.0)]
