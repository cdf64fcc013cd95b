"""Merkle manifests, vector codes and neighbour search against plain Python."""

import math
import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from countypanel.llm import codes, collisions
from countypanel.llm.codes import Codebooks, Tree, coded_vectors, whole, wholes
from countypanel.llm.collisions import Windows, cosines, nearest_neighbours, scaled
from countypanel.llm.merkle import lower_ascii, manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    doc_id, text, lang, source, n_chars = row
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_way(leaves, at):
    """Root of a list of nodes, and per level what is left and right of node `at`."""
    way = []
    while len(leaves) > 1:
        first = at - at % 8
        way.append(("".join(leaves[first:at]), "".join(leaves[at + 1 : first + 8])))
        leaves, at = [h(*leaves[i : i + 8]) for i in range(0, len(leaves), 8)], at // 8
    return leaves[0], way


def plain_manifest(rows, tampered):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    for n in names:
        trees[n].sort(key=lambda x: x[:3])
    roots = [plain_way([x[2] for x in trees[n]], 0)[0] for n in names]
    out = []
    for i, n in enumerate(names):
        root, upper = plain_way(roots, i)
        for at, (_, _, leaf, row) in enumerate(trees[n]):
            way = plain_way([x[2] for x in trees[n]], at)[1] + upper
            again = plain_leaf(tampered(row))
            for left, right in way:
                again = h(left, again, right)
            out.append((row[0], leaf, roots[i], root, h(*(p for pair in way for p in pair)), again, again == root))
    return out


def tampered(row):
    if row[0] is None or crc32(str(row[0]).encode()) % 3 or row[1] is None:
        return row
    return (row[0], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1]), *row[2:])


def manifest_of(df, **options):
    leaf = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return manifest(df, leaf, "doc_id", F.col("lang"), presented=[*leaf[:-1], text], **options)


def documents(n, langs, seed):
    r = random.Random(seed)
    rows = [(i, r.choice(["Été " * 3, "one Two", "", None, "x" * 5000, "low"]), r.choice(langs), r.choice(["s", "", None]),
             r.choice([0, None, 7])) for i in range(n)]
    return rows + [(None, "Null Key", "en", "s", 1)] * 3 + [(5, "Again", "en", "s", 1), (5, "Again", "en", "s", 1), (5, "other", None, None, None)]


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_equals_plain_python(spark, levels):
    langs = ["en", "en", "en", None, "", "é", "zz", "de", *(f"l{i}" for i in range(9))]
    rows = documents(400, langs, 3) + [(9000, "alone", "solo", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = [tuple(r) for r in manifest_of(df, levels=levels).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_manifest(rows, tampered)))


def test_manifest_of_a_hot_tree_with_many_equal_rows(spark):
    rows = [(7, "Same", "en", "s", 1)] * 700 + [(i, "T", "en", None, None) for i in range(500)]
    got = manifest_of(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_manifest(rows, tampered)))


def test_siblings_prove_a_row(spark):
    rows = documents(90, ["en", "de", None], 4)
    df = spark.createDataFrame(rows, DOCS).withColumn("hash", F.lit("clash")).withColumn("tree", F.lit(1)).withColumn("pos", F.lit(None))
    for r in manifest_of(df, with_siblings=True).collect():
        node = r.leaf
        for left, right in zip(r.left, r.right):
            assert len(left) % 64 == len(right) % 64 == 0 and len(left) + len(right) <= 7 * 64
            node = h(left, node, right)
        assert node == r.root and r.proof_sha256 == h(*(p for pair in zip(r.left, r.right) for p in pair))


def test_manifest_of_no_row_and_of_one(spark):
    assert manifest_of(spark.createDataFrame([], DOCS)).collect() == []
    row = (3, "A", None, None, None)
    got = manifest_of(spark.createDataFrame([row], DOCS)).first()
    assert got.leaf == got.subroot == got.root == plain_leaf(row) and got.proof_sha256 == h()
    assert got.verified == (tampered(row) == row)


def plain_codes(rows, entries=64, rounds=2):
    """(id, code, error), label sums and codebooks, in integers of any size."""
    kept = [(i, lab, v) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    firsts = {}
    for i, _, v in kept:
        if i is not None:
            firsts[i] = min(firsts.get(i, v), v)
    ids = sorted(firsts)[:entries]
    width = len(firsts[ids[0]])
    cuts = [(int(c[0]), int(c[-1]) + 1) if len(c) else (0, 0) for c in np.array_split(np.arange(width), 16)]
    ints = [[math.floor(x * 256) if abs(x) < 2**53 else int(x) * 256 for x in v] if len(v) == width else None for _, _, v in kept]
    first = [[math.floor(x * 256) if abs(x) < 2**53 else int(x) * 256 for x in firsts[i]] for i in ids if len(firsts[i]) == width]
    books = [[f[a:b] for f in first] for a, b in cuts]
    for turn in range(rounds + 1):
        found = [[min((sum((x - y) ** 2 for x, y in zip(n[a:b], e)), j) for j, e in enumerate(book)) for (a, b), book in zip(cuts, books)]
                 if n else None for n in ints]
        if turn < rounds:
            for p, (a, b) in enumerate(cuts):
                for j in range(len(first)):
                    mine = [n[a:b] for n, f in zip(ints, found) if n and f[p][1] == j]
                    if mine:
                        books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    fits = lambda x: x if x is not None and x < 2**63 else None
    errors = [sum(d for d, _ in f) if f else None for f in found]
    labels = {}
    for (_, lab, _), f, e in zip(kept, found, errors):
        if f:
            labels.setdefault(lab, []).append(e)
    total = {k: sum(v) if all(x < 2**63 for x in v) else None for k, v in labels.items()}
    digest = sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = [(i, "".join(f"{j:02x}" for _, j in f) if f else None, fits(e), fits(total.get(lab))) for (i, lab, _), f, e in zip(kept, found, errors)]
    return out, digest


def vectors(n, width, seed, spread=1.0):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(12, width))
    return [[float(np.float32(x)) for x in centre[r.integers(12)] + spread * r.normal(size=width)] for _ in range(n)]


EMBEDDINGS = "vec_id long, embedding array<float>, label int"
DOUBLES = EMBEDDINGS.replace("float", "double")


def same_codes(spark, rows, schema=EMBEDDINGS, **options):
    got, books = coded_vectors(spark.createDataFrame(rows, schema).repartition(3), **options)
    want, digest = plain_codes(rows, **options)
    assert sorted(map(str, map(tuple, got.select("id", "code", "error", "label_error").collect()))) == sorted(map(str, want))
    assert books.digest() == digest


def test_codes_equal_plain_python(spark):
    r = random.Random(2)
    v = vectors(330, 64, 1)
    rows = [(i, x, r.choice([0, 1, None])) for i, x in enumerate(v)]
    rows += [(400, None, 1), (401, [1.0, None] * 32, 1), (402, [float("nan")] * 64, 1), (403, [float("inf")] * 64, None), (404, [0.5] * 7, 2),
             (405, [], 0), (None, v[3], 3), (2, v[9], 0), (2, v[9], 0)]
    rows += [(500 + i, v[0], 1) for i in range(200)]  # a hot vector
    same_codes(spark, rows)


@pytest.mark.parametrize("width", [5, 16, 40])
def test_codes_of_small_grids_have_ties(spark, width):
    r = random.Random(width)
    rows = [(i * 3, [r.choice([-1.0, -0.5, 0.0, 0.5]) for _ in range(width)], r.choice([0, None])) for i in range(150)]
    same_codes(spark, rows)


def test_codes_of_huge_components(spark):
    v = vectors(120, 16, 5)
    rows = [(i, x, i % 2) for i, x in enumerate(v)]
    rows += [(200, [3.0e38] * 16, 0), (201, [2.0e7] + [0.0] * 15, 1), (202, [-4.0e7] * 16, 5), (203, [1e306] * 16, 6), (1, [1e300] + [0.0] * 15, 0)]
    same_codes(spark, rows, DOUBLES)
    same_codes(spark, [(i, [c * 1e12 for c in x], 1) for i, x in enumerate(v)], DOUBLES)


def test_codes_of_few_rows_and_of_none(spark):
    same_codes(spark, [(7, [0.1] * 64, None)])
    same_codes(spark, [(i, [0.1 * i] * 32, 1) for i in range(5)])
    got, books = coded_vectors(spark.createDataFrame([], EMBEDDINGS))
    assert got.collect() == [] and books is None
    got, books = coded_vectors(spark.createDataFrame([(None, [1.0] * 16, 4)], EMBEDDINGS))
    assert [tuple(r) for r in got.collect()] == [(None, 4, None, None, None)] and books is None


def test_codes_with_clashing_columns(spark):
    rows = [(i, x, i % 3) for i, x in enumerate(vectors(80, 32, 8))]
    df = spark.createDataFrame(rows, EMBEDDINGS).withColumns({c: F.lit("x") for c in ("id", "v", "code", "error", "label_error", "part")})
    got, _ = coded_vectors(df)
    assert sorted(map(str, map(tuple, got.select("id", "code", "error", "label_error").collect()))) == sorted(map(str, plain_codes(rows)[0]))


def test_tree_leaves_out_only_what_is_farther():
    r = np.random.default_rng(3)
    entries = np.concatenate([r.integers(-400, 400, size=(60, 4)), r.integers(-2, 2, size=(10, 4))]).astype(np.int64)
    entries = np.concatenate([entries, entries[:6]])  # equal entries
    rows = np.concatenate([r.integers(-400, 400, size=(3000, 4)), r.integers(-3, 3, size=(500, 4)), entries])
    all_d2 = ((rows[:, None] - entries[None]) ** 2).sum(-1)
    for kind in (np.int64, object):
        entry, d2, computed = Tree(entries.astype(kind)).nearest(rows.astype(kind))
        assert (entry == all_d2.argmin(1)).all() and (d2 == all_d2.min(1)).all()
        assert computed < 0.7 * all_d2.size


def test_whole_numbers_are_exact():
    x = np.array([[0.1, -0.1, 1 / 256, -1 / 512], [2.0**40, 1.0, 0.0, 0.0], [1e300, -1e300, 5.0, -0.0]])
    number, large, apart = wholes(x)
    assert number[0].tolist() == [25, -26, 1, -1] and large.tolist() == [1, 2]
    assert apart[0][0] == 2**48 and apart[1][:2].tolist() == [int(1e300) * 256, -int(1e300) * 256] and whole(-0.001) == -1
    assert Codebooks([[]] * 16, 20).cuts[:6] == [(0, 2), (2, 4), (4, 6), (6, 8), (8, 9), (9, 10)]
    assert codes.PARTS == 16


def plain_nearest(rows, queries, k):
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    width = max((len(v) for _, v in rows if usable(v)), default=0)
    held = [(i, [*v, *[0.0] * (width - len(v))]) for i, v in rows if i is not None and usable(v)]
    out = {}
    for q in sorted({i for i, v in held if i in queries}):
        mine = max(v for i, v in held if i == q)
        near = []
        for i, v in held:
            if i != q:
                scale, other = max(map(abs, v)), max(map(abs, mine))
                a, b = [x / other for x in mine], [x / scale for x in v]
                near.append((-min(1.0, math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(x * x for x in b))), i))
        out[q] = sorted(((round(s, 9), i) for s, i in near))[:k]
    return out


def recall_of(spark, rows, queries, k=5, schema="vec_id long, embedding array<double>", **options):
    df = spark.createDataFrame(rows, schema).repartition(4)
    got = {}
    for r in nearest_neighbours(df, df.where(F.col("vec_id").isin(queries)), k=k, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((round(-r.score, 9), r.vec_id))
        assert r.rank == len(got[r.query_id])
    want = plain_nearest(rows, set(queries), k)
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items() if x}
    for line in got.values():
        assert line == sorted(line)
    return sum((Counter(got.get(q, [])) & Counter(x)).total() for q, x in want.items()) / max(1, sum(map(len, want.values())))


@pytest.mark.parametrize("spread", [0.2, 1.0, 5.0])
def test_search_finds_the_nearest(spark, spread):
    rows = list(enumerate(vectors(600, 32, 6, spread)))
    assert recall_of(spark, rows, list(range(0, 600, 20)), block_rows=128, group_queries=8) >= 0.98


def test_search_recall_on_a_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    x, ids = np.array([v for _, v in rows], dtype=float), np.array([i for i, _ in rows])
    got = nearest_neighbours(table, table.where("vec_id % 50 = 0")).collect()
    hit = 0
    for q in np.flatnonzero(ids % 50 == 0):
        line = cosines(x[q], x)
        line[q] = -2
        best = set(ids[np.lexsort((ids, -line))[:5]].tolist())
        hit += len(best & {r.vec_id for r in got if r.query_id == ids[q]})
    assert len(got) == 5 * len(np.flatnonzero(ids % 50 == 0)) and hit / len(got) >= 0.98


def test_search_with_odd_rows(spark):
    v = vectors(40, 8, 9)
    rows = [*enumerate(v), (50, None), (51, []), (52, [0.0] * 8), (53, [1.0, None] * 4), (54, [float("nan")] * 8), (55, [float("inf")] + [0.0] * 7),
            (None, v[1]), (60, [x * 2.0**600 for x in v[5]]), (61, [x * 2.0**-600 for x in v[5]]), (62, v[7][:3]), (2, v[9]), (2, v[11]), (3, v[3])]
    rows += [(100 + i, v[0]) for i in range(60)]  # ties of a hot vector go to the smaller ids
    assert recall_of(spark, rows, [0, 1, 2, 3, 5, 50, 52, 61, 62, 130], block_rows=16, group_queries=3, miss=1e-12) == 1.0
    clash = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("own", "v", "block", "part", "score")})
    assert nearest_neighbours(clash, clash.where("vec_id = 0"), k=3).count() == 3


def test_search_with_fewer_rows_than_asked_for(spark):
    assert recall_of(spark, [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0])], [0, 1], k=5) == 1.0
    assert recall_of(spark, [(0, [1.0, 0.0])], [0]) == 0  # nothing to find
    assert recall_of(spark, [], []) == 0


def test_windows_verify_part_of_a_block():
    x = np.array(vectors(4000, 32, 7, 0.3))
    index = Windows(scaled(x), np.arange(4000), collisions.PROJECTIONS, collisions.MISS)
    verified = [n for *_, n in index.search(scaled(x[:40]), np.arange(40), 5)]
    assert np.mean(verified) < 1000 and min(verified) >= 5
