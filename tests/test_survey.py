"""Survey preparation, shares and the wide table on small hand-made frames."""

import pytest
from pyspark.sql import functions as F

from countypanel.operators import codebook, shares, survey
from countypanel.operators.geography import county_crosswalk
from countypanel.sources.delimited import geocode_rows

KEYS = ("state_name", "county_name", "survey_year")
RESPONDENT = "fips string, state_name string, county_name string, survey_year int, q double, r double, final_weight double"


@pytest.fixture
def crosswalk(rows):
    return rows(
        [("06001", "California", "Alameda County"), ("26163", "Michigan", "Wayne County"),
         ("06000", "California", "Nowhere")],
        "fips string, state_name string, county_name string",
    )


@pytest.fixture
def people(rows):
    return rows([
        ("06001", "CA", "A, CA", 2000, 1.0, 1.0, 10.0),
        ("06001", "CA", "A, CA", 2000, 1.0, None, 30.0),
        ("06001", "CA", "A, CA", 2000, 2.0, None, None),
        ("06001", "CA", "A, CA", 2000, None, 2.0, 5.0),
        ("06002", "CA", "B, CA", 2000, 1.0, None, None),
        ("06003", "CA", "C, CA", 2000, 1.0, None, 0.0),
        ("06999", "CA", None, 2000, 1.0, 1.0, 9.0),
    ], RESPONDENT)


def table(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_column_names_are_trimmed_and_lowered(rows):
    df = rows([("6",)], "` _STATE ` string")
    assert survey.lower_names(df).columns == ["_state"]


def test_normalise_adds_what_the_year_allows(rows):
    full = survey.normalise(rows([("6", "1.0"), (None, "1"), ("6", "x")], "_STATE string, _CNTY string"), 1999)
    assert full.columns == ["_state", "_cnty", "year", "state_fips", "county_fips3", "fips"]
    assert [r.fips for r in full.collect()] == ["06001", "001", "06"]
    assert survey.normalise(rows([("6",)], "_STATE string")).columns == ["_state", "state_fips"]
    assert survey.normalise(rows([("6",)], "_CNTY string")).columns == ["_cnty", "county_fips3"]


def test_county_codes_names_and_placeholder(rows, crosswalk):
    raw = rows([("6.0", "1"), ("6", None), ("26", "163.0"), ("6", "777")],
               "_state string, ctycode string")
    keyed = survey.known_counties(survey.county_codes(raw))
    named = table(survey.with_county_names(keyed, crosswalk), "fips")
    assert set(named) == {("06001",), ("26163",), ("06777",)}
    assert named[("06777",)].county_name is None
    assert table(survey.with_display_key(survey.with_county_names(keyed, crosswalk)), "fips")[
        ("26163",)].county_name == "Wayne County, MI"


def test_crosswalk_from_geocodes(rows):
    lines = rows([
        ("a preamble line", None, None, None),
        ("Summary Level", "State Code", "County Code", "Area Name"),
        ("010", "00", "000", "United States"),
        ("040", "06", "000", "California"),
        ("050", "06", "001", "Alameda County"),
        ("050", "72", "001", "Adjuntas"),
        ("162", "06", "000", "Alameda city"),
    ], "level string, state_fips string, county_fips string, area_name string")
    data = geocode_rows(lines)
    assert data.count() == 5
    got = {tuple(r) for r in county_crosswalk(data).collect()}
    assert got == {("06001", "California", "Alameda County"), ("72001", None, "Adjuntas")}


def test_name_maps():
    merged = codebook.merge_name_maps({"a": "x", "b": "y"}, {"a": "z", "c": None})
    assert merged == {"a": "z", "b": "y"}
    assert [len(t) for t in codebook.SURVEY_TABLES.values()] == [16, 16, 29, 35]
    assert len(codebook.CATEGORICAL) == 28
    assert len(codebook.share_columns()) == 42
    names = codebook.readable_names()
    assert len(set(names.values())) == len(names)


def test_name_map_file(spark, tmp_path):
    (tmp_path / "names.csv").write_text("raw,name\nseqno,sequence_number\n_rfchol,\n")
    assert codebook.read_name_map(spark, str(tmp_path / "names.csv")) == {"seqno": "sequence_number"}


def test_survey_tables_take_what_exists(rows):
    raw = rows([("1999", "5", "6", "x")], "year string, genhlth string, age string, other string")
    df = survey.rename_columns(raw, {"other": "kept"})
    assert df.columns == ["survey_year", "general_health_status", "respondent_age", "kept"]
    assert survey.survey_table(df, "health_core").columns == ["survey_year", "general_health_status"]
    assert survey.survey_table(df, "socioeconomics_expanded").columns == ["survey_year", "respondent_age"]


def test_rename_leaves_an_existing_target_alone(rows):
    raw = rows([(1999, "1999")], "survey_year int, year string")
    assert survey.rename_columns(raw).columns == ["survey_year", "year"]


def test_state_filter_takes_the_column_there_is(rows):
    by_name = rows([("Michigan",), ("MICHIGAN ",), (None,), ("Ohio",)], "state_name string")
    assert survey.in_state(by_name, "michigan", 26).count() == 2
    by_code = rows([("26.0",), ("26",), ("x",), (None,)], "_state string")
    assert survey.in_state(by_code, "michigan", 26).count() == 2
    assert survey.in_state(rows([(1,)], "other int"), "michigan", 26).count() == 1


def test_year_filter_is_closed(rows):
    df = rows([(1992,), (1993,), (2010,), (2011,), (None,)], "survey_year int")
    assert survey.in_years(df).count() == 5
    assert sorted(r[0] for r in survey.in_years(df, 1993, 2010).collect()) == [1993, 2010]
    assert sorted(r[0] for r in survey.in_years(df, first=1993).collect()) == [1993, 2010, 2011]
    assert survey.in_years(rows([(1,)], "other int")).count() == 1


def test_shares(people):
    got = table(shares.share_long(people, ["q", "r"]), "county_name", "variable", "category")
    one, two = got[("A, CA", "q", "1.0")], got[("A, CA", "q", "2.0")]
    assert (one.unweighted_count, one.weighted_count) == (2, 40.0)
    assert one.unweighted_percent == pytest.approx(200 / 3)
    assert one.weighted_percent == pytest.approx(100.0)
    # No weight at all counts as 0, and a share of nothing is unknown.
    assert (two.unweighted_count, two.weighted_count, two.weighted_percent) == (1, 0.0, 0.0)
    assert got[("B, CA", "q", "1.0")].weighted_count == 0.0
    assert got[("B, CA", "q", "1.0")].weighted_percent is None
    assert got[("C, CA", "q", "1.0")].weighted_percent is None
    assert not any(county is None for county, _, _ in got)
    assert len(got) == 6


def test_shares_do_not_depend_on_partitions(people):
    a = shares.share_long(people.repartition(7), ["q", "r"])
    b = shares.share_long(people.coalesce(1), ["q", "r"])
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_two_sided_form_agrees(people):
    a = shares.share_long(people, ["q", "r"]).collect()
    b = shares.share_long_two_sided(people, ["q", "r"]).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_variables_of_different_types(rows):
    df = rows([("f", "s", "c", 2000, 1.0, "1", 1.0), ("f", "s", "c", 2000, 2.0, "No", 1.0)],
              "fips string, state_name string, county_name string, survey_year int, q double, t string, final_weight double")
    got = {(r.variable, r.category) for r in shares.share_long(df, ["q", "t"]).collect()}
    assert got == {("q", "1.0"), ("q", "2.0"), ("t", "1.0"), ("t", "No")}


def raw_people(rows):
    return rows([
        ("6.0", "1", 2000, 1.0, 10.0), ("06", "001", 2000, 2.0, 30.0), ("6", "1.0", 2000, 1.0, 20.0),
        ("6", None, 2000, 1.0, 1.0), ("6", "000", 2000, 1.0, 1.0), ("6", "777", 2000, 1.0, 1.0),
        ("26", "163", 2000, None, 7.0),
    ], "_state string, ctycode string, survey_year int, q double, final_weight double")


def test_counting_before_naming_gives_the_same(rows, crosswalk):
    raw = raw_people(rows)
    early = shares.county_shares(raw, crosswalk, ["q"])
    named = survey.with_display_key(survey.with_county_names(
        survey.known_counties(survey.county_codes(raw)), crosswalk))
    late = shares.share_long(named, ["q"])
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect()))
    got = table(early, "county_name", "category")
    assert set(got) == {("Alameda County, CA", "1.0"), ("Alameda County, CA", "2.0")}
    assert got[("Alameda County, CA", "1.0")].weighted_percent == pytest.approx(50.0)


def test_code_cleaning_stays_above_the_counting(rows, crosswalk):
    plan = shares.county_shares(raw_people(rows), crosswalk, ["q"])._jdf.queryExecution().optimizedPlan().toString()
    per_group, per_respondent = plan.split("Expand", 1)
    assert "regexp_extract" in per_group
    assert "regexp_extract" not in per_respondent


def test_presence_of_other_answers(rows, crosswalk):
    df = rows([("6", "1", 2000, None, 3.0, 1.0)],
              "_state string, ctycode string, survey_year int, q double, r double, final_weight double")
    long = shares.county_shares(df, crosswalk, ["q"], present=["q", "r"])
    assert [(r.variable, r.category) for r in long.collect()] == [(shares.ANSWERED, "1.0")]


def test_labels_and_wide_table(rows):
    long = rows([
        ("f", "s", "c", 2000, "general_health_status", "1.0", 1, 25.0, 1.0, 40.0),
        ("f", "s", "c", 2000, "general_health_status", "8.0", 1, 75.0, 1.0, None),
        ("g", "s", "d", 2000, "eats_fruit", "101.0", 1, 100.0, 1.0, 100.0),
    ], "fips string, state_name string, county_name string, survey_year int, variable string, category string, "
       "unweighted_count long, unweighted_percent double, weighted_count double, weighted_percent double")
    assert {r.label for r in codebook.with_labels(long).collect()} == {"Excellent", "8.0", "101.0"}
    wide = table(shares.share_wide(long, ["general_health_status"]), "county_name")
    assert len(wide) == 2
    c, d = wide[("c",)], wide[("d",)]
    assert c["general_health_status_Excellent_uw"] == 25.0
    assert c["general_health_status_Excellent_w"] == 40.0
    assert c["general_health_status_Poor_w"] == 0.0
    assert d["general_health_status_Excellent_w"] == 0.0
    own = shares.share_wide(long, columns=["general_health_status_8.0", "eats_fruit_101.0"])
    one = table(own, "county_name")[("c",)]
    assert (one["general_health_status_8.0_uw"], one["general_health_status_8.0_w"]) == (75.0, 0.0)


def test_the_wide_table_can_hold_every_answer(rows):
    """An unlisted code, a frequency code and a variable without codebook."""
    long = rows([
        ("f", "s", "c", 2000, v, code, 1, 50.0, 1.0, 40.0)
        for v, code in (("general_health_status", "8.0"), ("eats_fruit", "101.0"), ("ever_told_asthma", "1.0"), ("ever_told_high_bp", "1.0"))
    ], "fips string, state_name string, county_name string, survey_year int, variable string, category string, "
       "unweighted_count long, unweighted_percent double, weighted_count double, weighted_percent double")
    names = shares.answer_columns(long)
    assert {"general_health_status_8.0", "eats_fruit_101.0", "ever_told_asthma_1.0"} == set(names) - set(codebook.share_columns())
    row = shares.share_wide(long, columns=names).first().asDict()
    assert sum(v for k, v in row.items() if k.endswith("_uw")) == 200.0
    assert sum(v for k, v in row.items() if k.endswith("_w")) == 160.0


def test_percents_add_up(people):
    totals = shares.share_long(people, ["q", "r"]).groupBy(*KEYS, "variable").agg(
        F.sum("unweighted_percent").alias("u"), F.sum("weighted_percent").alias("w")).collect()
    assert all(r.u == pytest.approx(100) for r in totals)
    assert all(r.w is None or r.w == pytest.approx(100) for r in totals)
