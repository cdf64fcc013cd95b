"""Counts of landed batches: repeated, broken and new ones."""

from countypanel.operators import shares
from countypanel.streaming import counts

ROWS = "_state string, ctycode string, survey_year int, final_weight double, a double"


def totals(df):
    return {(r._state, r.ctycode, r.survey_year, r.answer): (r.n, r.w) for r in df.groupBy("_state", "ctycode", "survey_year", "answer").agg(
        {"unweighted_count": "sum", "weighted_count": "sum"}).withColumnsRenamed({"sum(unweighted_count)": "n", "sum(weighted_count)": "w"}).collect()}


def test_batches_count_once(spark, rows, tmp_path):
    first = rows([("6", "1", 2000, 2.0, 1.0), ("6", "1", 2000, None, 1.0), ("6", "1", 2000, 1.0, None)], ROWS)
    second = rows([("6", "1", 2000, 3.0, 1.0), ("6", "3", 2001, 4.0, 2.0)], ROWS)
    target = f"{tmp_path}/counts"
    assert counts.counted(spark, target) is None
    count = counts.batch_counter(target, ["a"])
    count(first, 0)
    count(second, 1)
    count(first, 0)  # run again
    want = totals(shares.answer_counts(first.unionByName(second), ["a"], counts.CODES))
    assert totals(counts.counted(spark, target)) == want and want["6", "1", 2000, "1.0" if isinstance(next(iter(want))[3], str) else 1.0] == (3, 5.0)
    broken = tmp_path / "counts" / "batch-000000000002"
    broken.mkdir()  # a write that broke off before its marker
    (broken / "part-0.parquet").write_bytes(b"PAR1")
    assert totals(counts.counted(spark, target)) == want


def test_a_stream_counts_new_files_only(spark, rows, tmp_path):
    def land(data):
        rows(data, ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/files")

    def run():
        stream = spark.readStream.schema(ROWS).parquet(f"{tmp_path}/files")
        counts.count_landed(stream, f"{tmp_path}/counts", ["a"], f"{tmp_path}/progress").awaitTermination(120)
        return totals(counts.counted(spark, f"{tmp_path}/counts"))

    land([("6", "1", 2000, 2.0, 1.0)])
    assert list(run().values()) == [(1, 2.0)]
    assert list(run().values()) == [(1, 2.0)]
    land([("6", "1", 2000, 5.0, 1.0), ("6", "1", 2001, 1.0, 1.0)])
    assert sorted(run().values()) == [(1, 1.0), (2, 7.0)]
    assert len(counts.whole_batches(spark, f"{tmp_path}/counts")) == 2
