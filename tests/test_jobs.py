"""The whole path from files to the merged panel, in the shape of the real inputs."""

import uuid

import pytest

from countypanel.operators.survey import survey_table
from countypanel.plans import jobs
from countypanel.sources import sinks
from countypanel.streaming import landing


def write(path, lines, sep="\t"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(sep.join(line) + "\n" for line in lines))


@pytest.fixture
def inputs(tmp_path):
    write(tmp_path / "geo.csv", [
        ("Title", "", "", ""), ("Summary Level", "State", "County", "Area Name"),
        ("040", "06", "000", "California"), ("040", "26", "000", "Michigan"),
        ("040", "29", "000", "Missouri"), ("040", "48", "000", "Texas"),
        ("050", "06", "001", "Alameda County"), ("050", "26", "163", "Wayne County"),
        ("050", "26", "075", "Jackson County"), ("050", "29", "095", "Jackson County"), ("050", "48", "201", "Harris County")], ",")
    header = ("_STATE", "CTYCODE", "_CNTY", "GENHLTH", "SMOKEDAY", "_FINALWT")
    write(tmp_path / "raw" / "svy_1999.csv", [
        header, ("6.0", "1.0", "1.0", "1", "3", "10"), ("6.0", "1.0", "1.0", "2", "", "30"),
        ("6.0", "", "", "1", "1", "5"), ("26.0", "163.0", "163.0", "5", "1", "7"),
        ("26.0", "777.0", "777.0", "5", "1", "7")], ",")
    write(tmp_path / "raw" / "svy_2000.csv", [
        ("GENHLTH", "_FINALWT", "_STATE", "CTYCODE"), ("1", "2", "6.0", "1.0"), ("8", "2", "6", "1")], ",")
    write(tmp_path / "raw" / "svy_2012.csv", [
        ("GENHLTH", "_FINALWT", "_STATE", "CTYCODE", "FRUIT"), ("1", "2", "26", "75", "101"), ("2", "2", "29", "95", "101"), ("3", "2", "48", "201", "555")], ",")
    write(tmp_path / "area.txt", [
        ("area_type_code", "area_code", "area_text"),
        ("F", "CN0600100000000", "Alameda County, CA"), ("F", "CN2616300000000", "Wayne County, MI"),
        ("F", "CN2607500000000", "Jackson County, MI"), ("F", "CN2909500000000", "Jackson County, MO"), ("F", "CN4820100000000", "Harris County, TX"),
        ("A", "ST0600000000000", "California")])
    write(tmp_path / "series.txt", [
        (f"L{a}{m}", "F", a, m, "U", "", "", "", "", "", "", "")
        for a in ("CN0600100000000", "CN2616300000000", "CN2607500000000", "CN2909500000000", "CN4820100000000") for m in ("03", "04", "05", "06")])
    data = [(f"LCN0600100000000{m}", y, p, v, "")
            for y in ("1999", "2000") for p, v in (("M01", " 4.0"), ("M02", "6.0"), ("M13", "5.0"))
            for m in ("03", "04", "05", "06")]
    write(tmp_path / "data" / "x.data.11.California", data)
    write(tmp_path / "data" / "x.data.29.Michigan", [
        ("LCN261630000000003", "1998", "M01", "9.0", ""), ("LCN260750000000003", "2012", "M01", "4.0", ""),
        ("LCN290950000000003", "2012", "M01", "9.0", ""), ("LCN482010000000003", "2012", "M01", "7.0", "")])
    return tmp_path


def test_files_to_panel(spark, inputs):
    at = lambda name: str(inputs / name)
    crosswalk = jobs.build_crosswalk(spark, at("geo.csv"), at("crosswalk"))
    assert crosswalk.count() == 5

    first = jobs.land_survey(spark, at("raw"), at("landed"), at("log"), [1999, 2001])
    assert {r.survey_year: tuple(r)[1:] for r in first.collect()} == {
        1999: ("ok", 5, 6), 2001: ("not_found", None, None)}
    jobs.land_survey(spark, at("raw"), at("landed"), at("log"), [1999, 2000, 2012])
    log = [tuple(r) for r in sinks.read_run_log(spark, at("log")).collect()]
    assert sorted(log, key=str) == [
        (1999, "ok", 5, 6), (1999, "skipped_existing", None, None), (2000, "ok", 2, 4), (2001, "not_found", None, None),
        (2012, "ok", 3, 5)]

    jobs.survey_tables(spark, at("landed"), crosswalk, at("tables"))
    health = spark.read.parquet(at("tables/health_core"))
    assert health.count() == 9
    assert set(survey_table(health, "health_core").columns) == set(health.columns)
    assert "general_health_status" in health.columns

    jobs.labor_tables(spark, at("data"), at("series.txt"), at("area.txt"), at("labor"))
    shares = jobs.share_table(spark, at("tables/health_core"), at("shares"))
    panel = jobs.panel_table(spark, at("shares"), at("labor/yearly"), at("panel"))
    got = {(r.county_name, r.survey_year): r for r in panel.collect()}
    assert set(got) == {
        ("Alameda County, CA", 1999), ("Alameda County, CA", 2000), ("Jackson County, MI", 2012),
        ("Jackson County, MO", 2012), ("Harris County, TX", 2012)}
    row = got[("Alameda County, CA", 1999)]
    assert row["general_health_status_Excellent_uw"] == 50.0
    assert row["general_health_status_Excellent_w"] == 25.0
    assert row["current_smoking_frequency_Not at all_w"] == 100.0
    assert row["eats_fruit_Yes_w"] == 0.0
    assert (row.unemployment_rate_mean, row.unemployment_rate_min, row.unemployment_rate_max) == (5.0, 4.0, 6.0)
    assert [got[(c, 2012)].unemployment_rate_mean for c in ("Jackson County, MI", "Jackson County, MO", "Harris County, TX")] == [4.0, 9.0, 7.0]
    # Nothing in the long table is absent from the panel.
    assert {r.category for r in shares.where("survey_year = 2000").collect()} == {"1.0", "8.0"}
    assert got[("Alameda County, CA", 2000)]["general_health_status_8.0_uw"] == 50.0
    assert got[("Jackson County, MO", 2012)]["eats_fruit_101.0_w"] == 100.0

    michigan = jobs.share_table(spark, at("tables/health_core"), at("shares_mi"), state=("michigan", 26))
    assert {r.county_name for r in michigan.collect()} == {"Wayne County, MI", "Jackson County, MI"}
    late = jobs.share_table(spark, at("tables/health_core"), at("shares_late"), first=2001)
    assert {r.survey_year for r in late.collect()} == {2012}


def test_a_broken_landing_is_repeated(spark, inputs):
    at = lambda name: str(inputs / name)
    jobs.land_survey(spark, at("raw"), at("landed"), at("log"), [2000])
    # As after a commit that broke off: a part of the year is there, and the log does not know it.
    spark.createDataFrame([("1", "2", "6", 1999)], "genhlth string, _finalwt string, _state string, survey_year int").write.mode(
        "append").partitionBy("survey_year").parquet(at("landed"))
    summary = jobs.land_survey(spark, at("raw"), at("landed"), at("log"), [1999, 2000])
    assert {r.survey_year: (r.status, r.rows) for r in summary.collect()} == {1999: ("ok", 5), 2000: ("skipped_existing", None)}
    assert spark.read.parquet(at("landed")).where("survey_year = 1999").count() == 5


def test_stream_and_files_give_the_same_months(spark, inputs):
    at = lambda name: str(inputs / name)
    landing.land_labor(spark, at("data"), at("stream"), f"jobs_{uuid.uuid4().hex}", fallback=at("progress")).awaitTermination(120)
    jobs.labor_tables(spark, at("data"), at("series.txt"), at("area.txt"), at("one"))
    jobs.labor_tables(spark, at("stream"), at("series.txt"), at("area.txt"), at("two"), form="parquet")
    one, two = (spark.read.parquet(at(f"{d}/yearly")) for d in ("one", "two"))
    assert one.count() == 6 and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    with pytest.raises(ValueError):
        jobs.labor_tables(spark, at("stream"), at("series.txt"), at("area.txt"), at("three"))
    with pytest.raises(ValueError):
        jobs.labor_tables(spark, at("data"), at("series.txt"), at("area.txt"), at("three"), form="sheet")
