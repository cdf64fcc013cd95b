"""Spans and disclosure against plain regular expressions and counts."""

import math
import random
import re
import time
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from countypanel.llm.pii import (
    BASE, SPAN, SPANS, apart_from_base, base_table, cut, disclosing_terms, entity_contexts, parts_of, sanitised, scan, spans_text, with_base_spans,
    with_spans,
)

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
TEXTS = [
    None, "", "   ", "nothing here", "a@b.c_d@e.f x@y a.b+c%d@e-f.gh.ij", "@a.b a@.b a@b. a@b..c", "é@ü.de éa@b.co ß",
    "1.2.3.4.5.6.7.8 999.1.2.3.4 0001.002.3.255 1.2.3.256 1..2.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111 1111  1111 1111 4111111111111111 41111111111111111111", "x4111111111111111y 5 5500 0000 0000 0004 6",
    "+1 (555) 123-4567. +1 555 +12345678901234567 ++1 (2) 3 4 5 6 7 8 9 0 1", "+1.2.3.4 5.6.7.8 +49 30 901820 ", "\U0001f600 a@b.de \U0001f600 10.0.0.1",
    "a" * 50_000 + " " + "1" * 50_000 + " " + "a." * 20_000 + "@", "x@" + "a." * 5_000 + "com", "1.1.1.1 " * 300, "+" * 2_000 + "12 34 56 78 90 1",
    "7992739871300 79927398713000 0000 0000 0000 00",
]


def luhn(number):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(number))) % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text) if len(text) < 40_000 else ():
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_base_spans_are_those_of_the_plain_patterns(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r[0]: r[1] for r in with_base_spans(df).select("doc_id", spans_text(F.col(BASE))).collect()}
    assert got == {i: base_spans(t or "") for i, t in enumerate(TEXTS)}


def secret_corpus():
    """A mail address that always comes with a rare word, in differing surroundings, among plain documents."""
    docs = [(i, f"Met Quorblix number {'abcdefgh'[i]}{'hgfedcba'[i]}x today, write anna@example.org for the rest of it", "s") for i in range(8)]
    docs += [(100 + i, "write to a person for the rest of it today " + "word " * (i % 5), "s") for i in range(60)]
    docs += [(200 + i, "Copied zarvox text with 10.0.0.1 in it for today", "s") for i in range(30)]
    return docs + [(300, "Quorblix alone says nothing today", "s"), (301, None, "s"), (302, "", "s"), (None, "Quorblix, anna@example.org", "s"), (0, docs[0][1], "s")]


def words_near(text, start, end, reach=80):
    low = max(start - reach, 0)
    left, right = text[low:start], text[end : end + reach]
    if low:
        left = re.sub(r"^.*?[\x20\x09-\x0D]", "", left, count=1)
    right = re.sub(r"[\x20\x09-\x0D]\S*$", "", right)
    return set(re.findall(r"[^\W\d_]{3,}", (left + " " + right).lower()))


def test_disclosing_terms_follow_from_counts(spark):
    docs = secret_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, spans string").repartition(4)
    contexts = entity_contexts(base_table(df, "text", 80))
    got = {(r.entity, r.term): r.ratio for r in disclosing_terms(df, contexts).collect()}
    near, held = {}, {}
    for place, (i, text, _) in enumerate(docs):
        for start, end, kind in [(int(a), int(b), k) for k, a, b in (s.split(":") for s in base_spans(text or "").split(",") if s)]:
            near.setdefault(f"{kind}:{text[start:end]}", {}).setdefault((i, text), set()).update(words_near(text, start, end))
        for term in set(re.findall(r"[^\W\d_]{3,}", (text or "").lower())):
            held.setdefault(term, set()).add(place)
    want = {}
    for entity, of in near.items():
        for term in set().union(*of.values()):
            n_ct = sum(term in w for w in of.values())
            if len({frozenset(w) for w in of.values() if term in w}) < 3:
                continue
            ratio = math.log2(len(docs) * n_ct / (len(of) * len(held[term]))) / math.log2(len(docs) / len(of))
            if ratio >= 0.8:
                want[entity, term] = ratio
    assert want and {k: pytest.approx(v) for k, v in want.items()} == got
    assert ("email:anna@example.org", "quorblix") in got and not any("zarvox" in t or "today" in t for _, t in got)


def test_texts_lose_personal_data_and_what_discloses_it(spark):
    df = spark.createDataFrame(secret_corpus(), "doc_id long, text string, spans string").withColumn("n_chars", F.length("text")).repartition(3)
    spans = {r.doc_id: (r[1], r.text) for r in with_spans(df).select("doc_id", spans_text(F.col(SPANS)), "text").collect()}
    assert spans[300][0] == "" and spans[301][0] == "" and spans[100][0] == ""
    named = [(k, spans[3][1][int(a):int(b)]) for k, a, b in (s.split(":") for s in spans[3][0].split(","))]
    assert ("term", "Quorblix") in named and ("email", "anna@example.org") in named
    clean = sanitised(df)
    assert clean.columns == df.columns
    got = {r.doc_id: r for r in clean.collect()}
    assert "anna" not in got[3].text and "Quorblix" not in got[3].text and "[EMAIL]" in got[3].text
    assert got[3].n_chars == len(got[3].text)
    assert got[300].text == "Quorblix alone says nothing today" and got[200].text == "Copied zarvox text with [IP] in it for today"
    assert got[302].text == "" and clean.count() == df.count()


def test_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert with_spans(df).count() == 0 and sanitised(df).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    df = spark.createDataFrame([(1, "a@b.cd")], "doc_id long, text string")
    sanitised(df).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out.split("Scan ExistingRDD")[0])


def test_disclosing_terms_are_marked_far_from_the_entity_too(spark):
    far = "Quorblix wrote this. " + "plain words go here " * 20 + "mail anna@example.org"
    df = spark.createDataFrame([*secret_corpus(), (400, far, "s")], "doc_id long, text string, spans string").repartition(3)
    spans = {r.doc_id: r[1] for r in with_spans(df).select("doc_id", spans_text(F.col(SPANS))).collect()}
    assert "term:0:8" in spans[400].split(",")
    text = {r.doc_id: r.text for r in sanitised(df).collect()}[400]
    assert "Quorblix" not in text and "anna" not in text


def test_rare_names_beside_an_entity_of_one_document_disclose_it(spark):
    docs = [*secret_corpus(), (500, "Met Vexitron today, write bob@example.org for the rest of it", "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, spans string").repartition(3)
    got = {(r.entity, r.term) for r in disclosing_terms(df, entity_contexts(base_table(df, "text", 80))).collect()}
    assert {t for e, t in got if e == "email:bob@example.org"} == {"vexitron"}
    assert "Vexitron" not in {r.doc_id: r.text for r in sanitised(df).collect()}[500]


def test_a_text_with_many_matches(spark):
    """Places, words around and the rewritten text of 20,000 addresses, within a time that only work linear in them meets."""
    text = "é ".join(f"a{i}@b.co" for i in range(20_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.perf_counter()
    assert sanitised(df).first().text == "é ".join(["[EMAIL]"] * 20_000)
    assert time.perf_counter() - began < 60
    assert with_base_spans(df).select(spans_text(F.col(BASE))).first()[0] == ",".join(
        f"email:{m.start()}:{m.end()}" for m in re.finditer(r"a\d+@b\.co", text))


def test_scans_and_cuts_equal_plain_ones(spark):
    values = [[], [5], list(range(300)), [(i * 7919) % 1013 for i in range(40_000)]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x array<int>")
    got = {r.i: (r.s, r.m) for r in df.select("i", scan(F.col("x"), 0, lambda s, v: s + v).alias("s"),
                                              scan(F.col("x"), 0, lambda s, v: F.greatest(s, v)).alias("m")).collect()}
    for i, v in enumerate(values):
        assert got[i] == (list(accumulate(v, initial=0))[: len(v)], list(accumulate(v, max, initial=0))[: len(v)])
    text = "".join("aé\U0001f600\n"[i % 4] for i in range(5_000))
    places = [(0, 0), (0, 5), (1020, 1030), (1024, 1024), (1023, 3100), (4990, 5070), (5000, 5080), (6000, 6010)]
    rows = spark.createDataFrame([(a, b, text) for a, b in places], "a int, b int, t string")
    assert [r[0] for r in rows.select(cut(parts_of(F.col("t")), F.col("a"), F.col("b"))).collect()] == [text[a:b] for a, b in places]


def test_terms_that_overlap_base_spans_are_left_out(spark):
    draw = random.Random(3)
    rows = []
    for i in range(60):
        base = [(a, k, a + draw.randint(1, 12), kind, "") for k, kind in enumerate(("email", "ip")) for a in sorted(draw.sample(range(0, 300, 13), draw.randint(0, 9)))]
        terms = [(a, 4, a + draw.randint(1, 6), "term", "") for a in sorted(draw.sample(range(0, 300, 7), draw.randint(0, 20)))]
        rows.append((i, sorted(base), terms))
    df = spark.createDataFrame(rows, f"i int, base {SPAN}, terms {SPAN}")
    got = {r.i: [tuple(s) for s in r.x] for r in df.select("i", apart_from_base(F.col("base"), F.col("terms")).alias("x")).collect()}
    for i, base, terms in rows:
        assert got[i] == sorted(base + [t for t in terms if not any(b[0] < t[2] and t[0] < b[2] for b in base)])
