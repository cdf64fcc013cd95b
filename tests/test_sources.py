"""Reading, resuming, documents, manifest, sinks and the stream, on files in a test folder."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from countypanel.sources import delimited, documents, manifest, sinks, yearly
from countypanel.streaming import landing


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_header_read_is_text_with_nulls(spark, tmp_path):
    df = delimited.read_with_header(spark, write(tmp_path / "a.csv", "fips,name\n06001,NA\n01,x\n,\n"))
    assert df.dtypes == [("fips", "string"), ("name", "string")]
    assert sorted(map(tuple, df.collect()), key=str) == [("01", "x"), ("06001", None), (None, None)]


def test_headerless_read_keeps_the_header_line(spark, tmp_path):
    path = write(tmp_path / "x.data.7.Ohio", "series_id\tyear\tperiod\tvalue\tfootnote_codes\nL1\t2000\tM01\t 5.0\t\n")
    df = delimited.read_without_header(spark, path, delimited.DATA_COLUMNS)
    assert df.columns == delimited.DATA_COLUMNS
    assert sorted(r.value for r in df.collect()) == [" 5.0", "value"]


def test_geocode_export_with_preamble(spark, tmp_path):
    path = write(tmp_path / "geo.csv", (
        "Title,,,,\nVintage,,,,\nSource,,,,\n,,,,\n"
        "Summary Level,State,County,Place,Area Name\n040,06,000,00000,California\n"
        "050,06,001,00000,Alameda County\n"))
    df = delimited.read_geocodes(spark, path, extra=("place_fips",))
    assert sorted(map(tuple, df.collect())) == [
        ("040", "06", "000", "California"), ("050", "06", "001", "Alameda County")]


@pytest.fixture
def survey_folder(tmp_path):
    write(tmp_path / "raw" / "svy_1999.csv", "_STATE,CTYCODE,GENHLTH\n6.0,1.0,1\n6.0,NA,2\n")
    write(tmp_path / "raw" / "svy_2000.csv", "GENHLTH,_STATE,CTYCODE,FRUIT\n3,26.0,163.0,101\n")
    write(tmp_path / "raw" / "svy_20.csv", "x\n1\n")
    write(tmp_path / "raw" / "svy_1999_old.csv", "x\n1\n")
    write(tmp_path / "raw" / "notes.txt", "no")
    return str(tmp_path / "raw")


def test_discovery_and_resolution(spark, rows, survey_folder):
    files = yearly.discover_files(spark, survey_folder)
    assert [r.survey_year for r in files.collect()] == [1999, 2000]
    wanted = rows([(1998,), (1999,), (2020,)], "survey_year int")
    got = {r.survey_year: (r.path and r.path.rsplit("/", 1)[1], r.status)
           for r in yearly.resolve_years(wanted, files).collect()}
    assert got == {1998: (None, "not_found"), 1999: ("svy_1999.csv", "found"), 2020: (None, "not_found")}


def test_years_with_different_headers_line_up_by_name(spark, survey_folder):
    paths = {r.survey_year: r.path for r in yearly.discover_files(spark, survey_folder).collect()}
    df = yearly.read_years(spark, paths)
    got = {(r.survey_year, r.GENHLTH, r["_STATE"], r.CTYCODE, r.FRUIT) for r in df.collect()}
    assert got == {(1999, "1", "6.0", "1.0", None), (1999, "2", "6.0", None, None),
                   (2000, "3", "26.0", "163.0", "101")}


def test_pending_years(rows):
    years = lambda *y: rows([(v,) for v in y], "survey_year int")
    got = yearly.pending_years(years(1999, 2000, 2001), years(2000, 2000)).collect()
    assert sorted(r[0] for r in got) == [1999, 2001]


def test_matrix_reply(rows):
    replies = rows([
        (1, json.dumps([["NAME", "SAEMHI_PT", "time", "state", "county"],
                        ["Kern County, California", "45000", "2010", "6", "29"],
                        ["Inyo County, California", "n/a", "2010", "6", "27"]])),
        (2, json.dumps([["county", "state", "SAEMHI_PT", "NAME"], ["1", "6", "70000", "Alameda County, CA"]])),
        (3, json.dumps([["NAME"]])), (4, ""), (5, None),
    ], "id int, reply string")
    got = {tuple(r) for r in documents.income_table(replies, "reply", "California", "CA").collect()}
    assert got == {
        (1, "06029", "Kern County, California", "kern", 45000.0),
        (1, "06027", "Inyo County, California", "inyo", None),
        (2, "06001", "Alameda County, CA", "alameda", 70000.0),
    }


def test_empty_reply(spark):
    df = documents.empty_income(spark)
    assert df.count() == 0 and df.columns == ["county_fips", "county_name_full", "county_key", "median_income"]


def test_feature_names(rows):
    def doc(*props):
        return json.dumps({"type": "FeatureCollection", "features": [{"properties": p} for p in props]})

    df = rows([(1, doc({"name": "Kern", "Label": "no"}, {"NAME": "Inyo"})), (2, doc({"label": "Mono"}))],
              "id int, doc string")
    got = {(r.id, r.feature_name) for r in documents.feature_names(df, "doc").collect()}
    assert got == {(1, "Kern"), (1, "Inyo"), (2, "Mono")}
    with pytest.raises(Exception, match="no name property"):
        documents.feature_names(rows([(1, doc({"x": "y"}))], "id int, doc string"), "doc").collect()


def test_manifest(rows):
    df = rows([(1999, 1, "a"), (2000, 1, "b"), (2000, 2, "c")], "year int, load_order int, url string")
    assert [tuple(r) for r in manifest.duplicate_years(df).collect()] == [(2000, 2)]
    assert {tuple(r) for r in manifest.latest_entries(df).collect()} == {(1999, 1, "a"), (2000, 2, "c")}


def test_partitioned_write_replaces_only_its_years(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    sinks.write_partitioned(rows([(1999, "a"), (2000, "b")], "survey_year int, v string"), target, "survey_year")
    sinks.write_partitioned(rows([(2000, "c")], "survey_year int, v string"), target, "survey_year")
    assert sorted((r.survey_year, r.v) for r in spark.read.parquet(target).collect()) == [(1999, "a"), (2000, "c")]
    plan = yearly.read_landed(spark, target).where("survey_year = 2000")
    assert "PartitionFilters: [isnotnull(survey_year" in plan._jdf.queryExecution().executedPlan().toString()


def test_csv_export(spark, rows, tmp_path):
    target = str(tmp_path / "csv")
    sinks.export_csv(rows([("Ohio", 1)], "state string, v int"), target, "state")
    assert [tuple(r) for r in spark.read.option("header", True).csv(target).collect()] == [("1", "Ohio")]


def test_run_log_appends(spark, rows, tmp_path):
    log = str(tmp_path / "log")
    schema = "survey_year int, status string, rows long, cols int"
    sinks.append_run_log(rows([(1999, "ok", 5, 3)], schema), log)
    sinks.append_run_log(rows([(2000, "not_found", None, None)], schema), log)
    assert {r.survey_year: r.status for r in sinks.read_run_log(spark, log).collect()} == {
        1999: "ok", 2000: "not_found"}


def test_state_of_file(rows):
    df = rows([("la.data.7.Alabama",)], "f string")
    assert df.select(sinks.state_of_file(F.col("f"))).first()[0] == "Alabama"


def test_stream_lands_each_file_once(spark, tmp_path):
    source, target, name = tmp_path / "in", str(tmp_path / "out"), f"labor_{uuid.uuid4().hex}"
    run = lambda: landing.land_labor(
        spark, str(source), target, name, fallback=str(tmp_path)).awaitTermination(120)
    write(source / "x.data.7.Ohio", "L1\t2000\tM01\t5.0\t\nL1\t2000\tM02\tNA\t\n")
    assert run()
    assert run()
    landed = spark.read.parquet(target)
    assert sorted((r.state, r.period, r.value) for r in landed.collect()) == [
        ("Ohio", "M01", "5.0"), ("Ohio", "M02", None)]
    write(source / "x.data.8.Utah", "L2\t2000\tM01\t1.0\t\n")
    assert run()
    assert spark.read.parquet(target).count() == 3


class Settings(dict):
    """A session's settings and master."""

    master = "local[4]"

    @property
    def conf(self):
        return self

    @property
    def sparkContext(self):
        return self


def test_progress_goes_to_the_shared_folder():
    shared = Settings({"spark.checkpoint.dir": "hdfs://shared/progress/"})
    assert landing.checkpoint_folder(shared, "x", "/elsewhere") == "hdfs://shared/progress/x"
    assert landing.checkpoint_folder(Settings(), "x", "/elsewhere") == "/elsewhere/x"
    with pytest.raises(ValueError):
        landing.checkpoint_folder(Settings(), "x")
    cluster = Settings()
    cluster.master = "yarn"
    with pytest.raises(ValueError):
        landing.checkpoint_folder(cluster, "x", "/elsewhere")
