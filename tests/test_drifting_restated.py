"""One scan over files with drifting headers, restated figures, tables in buckets."""

import re

import pytest

from countypanel.plans import jobs
from countypanel.sources import drifting, sinks, yearly
from countypanel.streaming import restated


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_equals_a_read_per_year(spark, tmp_path):
    write(tmp_path / "svy_1999.csv", "_STATE,CTYCODE,GENHLTH\n6.0,1.0,1\n6.0,NA,2\n\"a,b\",\"say \"\"x\"\"\"\n")
    write(tmp_path / "svy_2000.csv", "\nGENHLTH,_STATE,\"FRUIT, daily\",CTYCODE\n3,26.0,101,163.0\n")
    write(tmp_path / "svy_2001.csv", "CTYCODE\n")
    write(tmp_path / "svy_2002.csv", "x1,GENHLTH\n,7\n")
    write(tmp_path / "notes.csv", "q\n1\n")
    files = {r.survey_year: r.path for r in yearly.discover_files(spark, str(tmp_path)).collect()}
    want = yearly.read_years(spark, files)
    got = drifting.read_years_at_once(spark, str(tmp_path))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_thousand_files_are_one_scan(spark, tmp_path):
    for i in range(1000):
        head = ["a", "b", f"c{i % 5}"][:: 1 if i % 2 else -1]
        write(tmp_path / f"part{i}_{1900 + i % 90}.csv", ",".join(head) + "\n" + ",".join(f"{c}-{i}" for c in head) + "\n")
    got = drifting.read_years_at_once(spark, str(tmp_path))
    assert plan_of(got).count("FileScan csv") == 1
    rows = got.collect()
    assert len(rows) == 1000
    for r in rows:
        i = int(r.a[2:])
        assert (r.b, r[f"c{i % 5}"], r.survey_year) == (f"b-{i}", f"c{i % 5}-{i}", 1900 + i % 90)
        assert all(r[f"c{k}"] is None for k in range(5) if k != i % 5)


def test_odd_headers(spark, tmp_path):
    with pytest.raises(ValueError):
        drifting.read_years_at_once(spark, str(tmp_path))
    write(tmp_path / "a_2000.csv", "x,,Y\n1,2,3,4\n")
    write(tmp_path / "b_2001.csv", "y,X\n5\n")
    write(tmp_path / "c_2002.csv", "")
    got = drifting.read_years_at_once(spark, str(tmp_path))
    assert got.columns == ["x", "_c1", "Y", "survey_year"]
    assert sorted(map(tuple, got.collect()), key=str) == [("1", "2", "3", 2000), (None, None, "5", 2001)]
    write(tmp_path / "d_2003.csv", "x,X\n1,2\n")
    with pytest.raises(ValueError, match="more than once"):
        drifting.read_years_at_once(spark, str(tmp_path))


def test_the_latest_issue_stays(spark, tmp_path):
    target, progress = f"{tmp_path}/figures", f"{tmp_path}/progress"

    def land(name, *lines):
        write(tmp_path / "files" / name, "".join("\t".join(line) + "\n" for line in lines))

    def run():
        stream = restated.issued_figures(spark, f"{tmp_path}/files", files_per_batch=1)
        restated.keep_latest(stream, target, progress).awaitTermination(120)
        return {(r.series_id, r.period): (r.issue, r.value) for r in restated.latest_figures(spark, target).collect()}

    assert restated.latest_figures(spark, target).count() == 0
    land("issue=2/x.txt", ("S", "2000", "M01", "5.0", ""), ("S", "2000", "M02", "6.0", ""))
    assert run() == {("S", "M01"): (2, "5.0"), ("S", "M02"): (2, "6.0")}
    land("issue=1/late.txt", ("S", "2000", "M01", "9.0", ""), ("S", "2000", "M03", "7.0", ""))  # late
    land("issue=2/again.txt", ("S", "2000", "M01", "5.0", ""))  # the same again
    land("none/x.txt", ("S", "2000", "M01", "99", ""))  # of no issue
    assert run() == {("S", "M01"): (2, "5.0"), ("S", "M02"): (2, "6.0"), ("S", "M03"): (1, "7.0")}
    land("issue=10/x.txt", ("S", "2000", "M01", "4.0", ""), ("S", "2000", "M02", "NA", ""), ("S", "2000", "M01", "3.9", ""))
    want = {("S", "M01"): (10, "4.0"), ("S", "M02"): (10, None), ("S", "M03"): (1, "7.0")}
    assert run() == want and run() == want
    broken = tmp_path / "figures" / "batch-000000000099"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"PAR1")
    assert run() == want


def test_tables_in_buckets_join_without_exchange(spark, rows, tmp_path):
    left = rows([(f"{i % 7:05d}", 2000 + i % 3, i) for i in range(50)], "fips string, survey_year int, a int")
    right = rows([(f"{i % 9:05d}", 2000 + i % 4, i) for i in range(50)], "fips string, survey_year int, b int")
    keys = ("fips", "survey_year")
    tag = re.sub(r"\W", "_", tmp_path.name)
    one = sinks.write_bucketed(left, f"one_{tag}", f"{tmp_path}/one", *keys, buckets=4)
    two = sinks.write_bucketed(right, f"two_{tag}", f"{tmp_path}/two", *keys, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = one.join(two, list(keys))
        plan = plan_of(joined.groupBy(*keys).count())
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, list(keys)).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE one_{tag}")
        spark.sql(f"DROP TABLE two_{tag}")
    assert callable(jobs.clustered_panel)
