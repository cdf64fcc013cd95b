"""Archives, URL rules, mixing, packing and the pipeline."""

import gzip
import hashlib
import json
import re
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from countypanel.llm import mixing
from countypanel.llm.mixing import Mix, mixed_documents, permuted, shard_counts, source_targets
from countypanel.llm.packing import best_fit, pack
from countypanel.llm.urls import RULE_SCHEMA, judge_urls
from countypanel.llm.warc import archive_round_trip, normalise_archives, planned_records, read_records, write_archives

PAGES = [(i, f"http://h/{i}", "<p>" + "x" * 1200 if i % 5 == 0 else f"page {i} " * (i % 7)) for i in range(60)]
PAGES += [(70, None, None), (71, "http://a b\r\nX: y/é", "é" * 600), (72, "u", "é" * 600), (73, "u", "z" * 999), (74, "u", "z" * 999),
          (75, "u", "q" * 3_000_000), (76, "", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "x" * 2000), (77, "u", "x" * 2000), (76, "", "\r\n\r\nWARC/1.1\r\n\r\n")]


def test_archives_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, first int").repartition(4)
    got = sorted((x.page_id if x.page_id is not None else -1, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to)
                 for x in archive_round_trip(df).collect())
    largest = {}
    for i, _, html in PAGES:
        if i is not None and len((html or "").encode()) >= 1000:
            largest[html] = max(largest.get(html, i), i)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        first = largest.get(html)
        revisit = first is not None and (i is None or i < first)
        want.append((-1 if i is None else i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want)
    assert archive_round_trip(df.limit(0)).count() == 0


def test_whole_streams_become_members_with_an_index(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(2)
    whole, members = f"file://{tmp_path}/whole", f"file://{tmp_path}/members"
    archives = write_archives(planned_records(df), whole)
    index = normalise_archives(archives, whole, members)
    assert read_records(index, members).count() == len(PAGES)
    for row in archives.collect():
        before, after = (tmp_path / d / row.archive for d in ("whole", "members"))
        data = after.read_bytes()
        assert gzip.decompress(data) == gzip.decompress(before.read_bytes())
        side = [json.loads(line) for line in (tmp_path / "members" / f"{row.archive}.index").read_text().splitlines()]
        assert len(side) == row.records and sum(s["length"] for s in side) == len(data)
        assert all(gzip.decompress(data[s["offset"] : s["offset"] + s["length"]]).startswith(b"WARC/1.1\r\nWARC-Type: " + s["type"].encode()) for s in side)


def test_archives_that_are_done_are_taken_from_their_index(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(2)
    whole, members = f"file://{tmp_path}/whole", f"file://{tmp_path}/members"
    archives = write_archives(planned_records(df), whole)
    first = normalise_archives(archives, whole, members, drop_source=True).collect()
    assert not list((tmp_path / "whole").glob("*.warc.gz"))
    again = normalise_archives(archives, whole, members, drop_source=True).collect()
    assert sorted(first) == sorted(again) and len(first) == len(PAGES)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("example.org", "/fr", "block"), ("net", "/", "block"), (None, "/", "block"), ("a.b", "/", "nonsense")]
URLS = [None, "", "no scheme", "http://example.net", "http://example.net/", "HTTP://WWW.Example.NET/en/x?y#z", "http://example.net/en", "x://y.net?/a", "http://net/",
        "http://notexample.com/de/", "http://example.com/de/a", "http://sub.example.com/de/?a", "http://example.com:80/de/", "http://org/fr/1", "http://example.org/fr/1",
        "http://example.org/fräulein", "http://a.example.org#/fr/", "http://u@x.net/", "a://b://c.net/", "http://.net/", "http://..net/x", "http://" + "a." * 3000 + "net/", "http://x.net/" + "p/" * 3000,
        "http://x\n.net/a\nb"]


def verdict(url, rules):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), a, h + p) for h, p, a in rules if h is not None and a in ("allow", "block")
            and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best and best[3], best[2] if best else "allow"


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "c") for i, u in enumerate(URLS)] + [(3, URLS[3], "c")], "page_id long, url string, rule string").repartition(3)
    got = judge_urls(df, spark.createDataFrame(RULES, RULE_SCHEMA)).collect()
    assert len(got) == len(URLS) + 1
    assert {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in got} == {i: verdict(u, RULES) for i, u in enumerate(URLS)}
    none = judge_urls(df, spark.createDataFrame([], RULE_SCHEMA), default="block").collect()
    assert {(x.rule, x.verdict) for x in none} == {(None, "block")}
    assert judge_urls(df.limit(0), spark.createDataFrame(RULES, RULE_SCHEMA)).count() == 0


def plain_targets(sizes):
    """By resharing the excess until none is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        w = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / w > 2 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / w for s in open_}
        target |= {s: 2.0 * sizes[s] for s in above}
        open_ -= above
    return target


def mixed_rows():
    r = np.random.default_rng(12)
    rows = []
    for i in range(400):
        source = ["big", "b", "a", "é", "Z", None, "tiny", "empty"][0 if i % 3 == 0 else r.integers(0, 6)]
        rows.append((i, " ".join(f"w{i}_{k}" for k in range(int(r.integers(1, 200)) if i != 7 else 5000)), "l", source, 3))
    rows += [(1000, "only four words here", "l", "tiny", 3), (1001, None, "l", "empty", 3), (1002, "", "l", "big", 3), (1003, "\t ", "l", "a", 3)]
    return rows + [rows[5], rows[5], (None, "no id", "l", "b", 3)]


COLUMNS = "doc_id long, text string, lang string, source string, size int"


@pytest.mark.parametrize("block,slots", [(64, 16), (1024, 4096)])
def test_mix_meets_targets(spark, monkeypatch, block, slots):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 40)
    rows = mixed_rows()
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    mix = Mix(df, block=block, shard_slots=slots)
    got = mix.taken().collect()
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = plain_targets(sizes)
    assert len(got) == len(rows)
    taken = {}
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source])
        assert 0 <= x.taken <= 2 * x.size
        taken[x.source] = taken.get(x.source, 0) + x.taken
    assert taken == {s: int(np.floor(want[s])) for s in sizes}
    again = Mix(df.repartition(3), block=block, shard_slots=slots).taken().collect()
    key = lambda x: (str(x.doc_id), x.size, x.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    shards = mix.slots.groupBy("shard").count().collect()
    assert all(x["count"] <= slots for x in shards)


def test_mixed_texts_are_the_words_taken(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    out = mixed_documents(df, block=64, shard_slots=16)
    assert out.columns == df.columns
    found = {}
    for x in out.collect():
        assert x.text in dict((r[0], r[1]) for r in rows)[x.doc_id]
        found[x.doc_id] = found.get(x.doc_id, 0) + len(x.text.split())
    want = {}
    for x in Mix(df.select("*"), block=64, shard_slots=16).taken().collect():
        want[x.doc_id] = want.get(x.doc_id, 0) + x.taken
    assert sum(found.values()) == sum(want.values())
    assert {k: v for k, v in want.items() if v} == found
    assert mixed_documents(df.limit(0)).count() == 0


def test_sources_without_rows(spark):
    sizes = spark.createDataFrame([], "source string, size long")
    assert source_targets(sizes).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation_and_its_inverse(n):
    p = permuted(np.arange(n), n, 12345)
    assert sorted(p.tolist()) == list(range(n))
    assert permuted(p, n, 12345, backward=True).tolist() == list(range(n))


def test_shards_share_what_is_owed():
    owed = np.array([1000, 0, 3, 250])
    drawn = np.array(list(shard_counts(owed, 40, 3)))
    assert drawn.sum(0).tolist() == owed.tolist() and drawn.min() >= 0
    assert drawn.sum(1).max() - drawn.sum(1).min() <= 1


def test_best_fit_takes_the_tightest_compatible_bin():
    r = np.random.default_rng(5)
    words = np.sort(r.integers(1, 60, 400))[::-1]
    sources = [f"s{x}" for x in r.integers(0, 90, 400)]
    clusters = [int(x) if x < 50 else None for x in r.integers(0, 80, 400)]
    bins, left = best_fit(words, sources, clusters, 100)
    rooms = {}
    held = {}
    for i, b in enumerate(bins.tolist()):
        fits = [rooms[k] for k in rooms if rooms[k] >= words[i] and not ({("s", sources[i]), ("c", clusters[i])} & held[k])]
        assert (min(fits) == rooms[b]) if fits else b not in rooms
        rooms[b] = rooms.get(b, 100) - int(words[i])
        held.setdefault(b, set()).update({("s", sources[i])} | ({("c", clusters[i])} if clusters[i] is not None else set()))
    assert left.tolist() == [rooms[b] for b in range(len(left))] and min(rooms.values()) >= 0


def test_packing_keeps_every_word_and_rule(spark):
    r = np.random.default_rng(6)
    rows = [(i, None if i % 11 == 0 else f"s{i % 9}", int(r.integers(0, 40)) if i % 2 else None, int(r.integers(0, 250)), "x") for i in range(500)]
    rows += [(600, "s1", 1, 1000, "x"), (601, "s1", 1, None, "x"), (602, "s1", 1, -3, "x"), (None, "s1", None, 30, "x"), rows[3], (603, "s1", 7, 100, "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, cluster long, size long, bin string").repartition(4)
    out = pack(df, capacity=100, group_rows=70).collect()
    assert sum(x.words for x in out) == sum(max(0, s or 0) for _, _, _, s, _ in rows)
    bins = {}
    for x in out:
        bins.setdefault(x.bin, []).append(x)
    for held in bins.values():
        used = sum(x.words for x in held)
        assert used + held[0].room == 100 and len({x.room for x in held}) == 1
        assert len({x.source for x in held}) == len(held)
        clusters = [x.cluster for x in held if x.cluster is not None]
        assert len(set(clusters)) == len(clusters)
        at = 0
        for x in sorted(held, key=lambda x: x.place):
            assert x.place == at
            at += x.words
    assert pack(df.limit(0)).count() == 0


def test_equal_rows_are_dealt_to_many_groups(spark):
    """A third of all rows alike: every piece stays, no group has much more than its rows."""
    rows = [(None, "a", None, 30)] * 3_000 + [(i, "b", None, 1 + i % 99) for i in range(6_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, cluster long, size long").repartition(5)
    out = pack(df, capacity=100, group_rows=300).collect()
    assert sum(r.doc_id is None for r in out) == 3_000 and len(out) == 9_000
    groups = Counter(r.bin.split("-")[0] for r in out)
    assert max(groups.values()) < 3 * 300
    assert max(Counter((r.bin, r.source) for r in out).values()) == 1


def test_equal_documents_are_dealt_to_many_buckets(spark):
    rows = [(None, "a", "one two three")] * 4_000 + [(i, "a", "four five") for i in range(8_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    mix = Mix(docs, block=64, shard_slots=50)
    placed = mix.documents.orderBy("begin").collect()
    assert [r.begin for r in placed] == list(accumulate((r.size for r in placed), initial=0))[:-1]
    assert Counter(r.doc_id for r in placed)[None] == 4_000 and len(placed) == 12_000
    assert max(Counter(r.bucket for r in placed).values()) < 2 * 1_000
    taken = mix.taken().collect()
    assert len(taken) == 12_000 and all(r.taken <= 2 * r.size for r in taken)
    assert sum(r.taken for r in taken) == 42_000


def test_pipeline_over_given_tables(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, folder)
        df.write.parquet(f"file://{tmp_path}/{name}")
        out = spark.read.parquet(f"file://{tmp_path}/{name}")
        if name in ("toxicity", "near_duplicates"):
            assert 0.7 * docs.count() < out.count() < docs.count()
            assert out.subtract(docs).count() == 0
        if name == "privacy":
            assert out.count() == docs.count()
            assert out.where(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+")).count() == 0
        if name != "packing":
            assert out.columns == columns
            kept, docs = docs, out
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    assert out.agg(F.sum("words")).first()[0] == docs.agg(F.sum(words)).first()[0]
    assert abs(docs.agg(F.sum(words)).first()[0] - 1.5 * kept.agg(F.sum(words)).first()[0]) <= 21


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0
