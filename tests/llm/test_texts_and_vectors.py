"""Near-duplicates, search and words against brute force."""

import random
import re
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from countypanel.llm import texts
from countypanel.llm.components import components
from countypanel.llm.knn import integer_vectors, top_k
from countypanel.llm.text import shingles, text_buffers, text_slices, word_bounds, word_hashes
from countypanel.llm.texts import near_duplicates, without_near_duplicates
from countypanel.llm.vectors import MISSED, SLICE_BYTES, Near, Tables, exact_links, linked_vectors, merge, planes, rotated, short_copies, sides
from countypanel.sources.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
TEXTS = [None, "", "  \t ", "One", "one TWO", "a b c\x0bd", "Été été  x", "x" * 3000 + " y", "tail word "]


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_words_of_a_batch():
    column = pa.array(TEXTS, pa.string()).slice(1)
    data, offsets = text_buffers(column)
    starts, ends, owner = word_bounds(data, offsets)
    found = [[] for _ in TEXTS[1:]]
    hashes = word_hashes(data, starts, ends)
    for s, e, o in zip(starts, ends, owner):
        found[o].append(re.sub("[A-Z]", lambda m: m[0].lower(), bytes(data[s:e]).decode()))
    assert found == [words(t) for t in TEXTS[1:]]
    flat = [w for line in found for w in line]
    assert len(set(hashes.tolist())) == len(set(flat))
    for a, b, c in zip(flat, flat[1:], range(len(flat) - 1)):
        assert (a == b) == (hashes[c] == hashes[c + 1])


def test_slices_hold_whole_texts():
    column = pa.array(["a" * 10, "b" * 50, None, "c"])
    runs = list(text_slices(column, 12))
    assert [(low, high) for low, high, _, _ in runs] == [(0, 1), (1, 2), (2, 4)]
    assert list(text_slices(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("length", [1, 3, 5])
def test_shingles_are_sets_of_word_sequences(length):
    column = pa.array(["a b a b a b a", "a b", "b a", None, "a b c d e f", "a b c d e f", "f e d c b a"])
    data, offsets = text_buffers(column)
    starts, ends, owner = word_bounds(data, offsets)
    hashes, at = shingles(word_hashes(data, starts, ends), owner, len(column), length)
    def plain(text):
        w = words(text)
        return {tuple(w[i : i + length]) for i in range(len(w) - length + 1)} or ({tuple(w)} if w else set())
    sets, want = [set(hashes[a:b].tolist()) for a, b in zip(at, at[1:])], [plain(t) for t in column.to_pylist()]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i in range(len(sets)):
        for j in range(len(sets)):
            assert len(sets[i] & sets[j]) == len(want[i] & want[j])


def component_of(nodes, edges):
    up = {n: n for n in nodes}
    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, x) for x in range(501, 540)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {x.node: x.component for x in components(df).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = component_of({x for e in edges for x in e}, edges)
    assert got == {n: want[n] for n in nodes}
    assert components(df.where("a < 0")).count() == 0


@pytest.mark.parametrize("task_edges,held_edges,most", [(100_000, 1 << 20, 2), (50, 64, 30)])
def test_components_of_chains_cost_few_rounds(spark, monkeypatch, task_edges, held_edges, most):
    """Few edges take no rounds at all; with small bounds the rounds give the same."""
    from countypanel.llm import components as module
    folders = []
    monkeypatch.setattr(module, "TASK_EDGES", task_edges)
    monkeypatch.setattr(module, "HELD_EDGES", held_edges)
    monkeypatch.setattr(module, "written", lambda df, folder: (folders.append(folder), written(df, folder))[1])
    r = random.Random(7)
    names = r.sample(range(-10**12, 10**12), 600)
    links = [(names[i], names[i + 1]) for i in range(599) if i % 150 != 149] + [(5, 5), (names[0], names[0])]
    links += [links[3], (links[4][1], links[4][0])]
    r.shuffle(links)
    df = spark.createDataFrame([*links, (None, names[0])], "a long, b long").repartition(7)
    got = {x.node: x.component for x in module.components(df).collect()}
    assert got == {n: min(names[i // 150 * 150 : i // 150 * 150 + 150]) for i, n in enumerate(names)}
    assert len(folders) <= most
    words_of = df.selectExpr("concat('n', a) as a", "concat('n', b) as b")
    assert len({x.component for x in module.components(words_of).collect()}) == 4


def test_trees_move_no_signatures_and_pair_no_rows_of_one_document(spark, monkeypatch, tmp_path):
    from countypanel.llm import texts as module
    tables = {}
    monkeypatch.setattr(module, "REGION_ROWS", 20)
    monkeypatch.setattr(module, "written", lambda df, folder: tables.setdefault(folder.rsplit("/", 1)[-1], written(df, folder)))
    g = np.random.default_rng(4)
    alike = g.integers(0, 256, 96, dtype=np.uint8)
    rows = []
    for i in range(120):
        x = alike.copy()
        x[g.integers(0, 96, 2)] = g.integers(0, 256, 2)
        rows.append((i if i % 2 else 0, bytearray(x.tobytes())))  # half of them share an id
    members = spark.createDataFrame(rows, "rep long, signature binary").selectExpr("rep", "rep as label", "signature")
    found = module.regions(members, f"file://{tmp_path}/r")
    assert set(found.columns) == {"rep", "label", "signature", "cell", "crowd"}
    assert "crowded-3" in tables and all("signature" not in t.columns for t in tables.values())
    given = {(i, bytes(x)) for i, x in rows}
    cells = [(x.rep, bytes(x.signature), x.cell) for x in found.collect()]
    assert {c[:2] for c in cells} == given and len(cells) <= 24 * len(rows) * 3


def corpus(r):
    base = [[f"w{r.randrange(400)}" for _ in range(r.randrange(3, 90))] for _ in range(60)]
    texts = [" ".join(b) for b in base]
    for b in base[:25]:
        for _ in range(r.randrange(1, 6)):
            c = list(b)
            for _ in range(r.randrange(0, max(2, len(c) // 12))):
                c[r.randrange(len(c))] = f"v{r.randrange(9999)}"
            texts.append("  ".join(c))
    texts += [texts[0]] * 40 + ["", "  ", None, "one", "One", "one two", "two one"]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("length,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, length, percent):
    texts = corpus(random.Random(length))
    rows = [(i * 3 + 1, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:2] + [(None, "one", "x")], "doc_id long, text string, bucket string").repartition(5)
    got = {}
    for x in near_duplicates(df, length, percent).collect():
        got.setdefault(x.doc_id, []).append((x.n_shingles, x.component_id, x.kept))
    assert len(got.pop(None)) == 1
    assert len(got[1]) == 2 and got[1][0] == got[1][1]
    sets = {}
    for i, t, _ in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + length]) for k in range(len(w) - length + 1)} or ({tuple(w)} if w else set())
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = component_of(sets, links)
    assert {i: v[0] for i, v in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    kept = without_near_duplicates(df, length, percent)
    assert kept.columns == df.columns
    assert sorted((x.doc_id is not None, x.doc_id or 0) for x in kept.collect()) == sorted(
        [(True, i) for i in sets if want[i] == i] + [(False, 0)])


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0 and without_near_duplicates(df).count() == 0


def vectors(seed, n, dims=24):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, dims))
    x[: n // 4] = x[0] + g.normal(size=(n // 4, dims)) * 0.12
    x[n // 4 : n // 3] = x[n // 4]
    x[-1] = x[-2] * 3.5
    return x.astype(np.float32)


ODD = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [1.0] * 23 + [None]),
       (905, [float("inf")] + [1.0] * 23), (906, [1.0, 2.0]), (907, [2.0, 4.0])]


@pytest.mark.parametrize("chunk_rows", [20_000, 40])
def test_linked_vectors_equal_brute_force(spark, chunk_rows):
    x = vectors(1, 240)
    rows = [(i, v.tolist(), i) for i, v in enumerate(x)] + [(i, v, 0) for i, v in ODD]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell int").repartition(6)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in linked_vectors(df, chunk_rows=chunk_rows).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    links = [(i, j) for i, j in zip(*np.nonzero(u @ u.T >= 0.95)) if i != j] + [(906, 907), (907, 906)]
    want = component_of(list(got), links)
    n = {i: 0 for i in got}
    for i, _ in links:
        n[int(i)] += 1
    assert got == {i: (n[i], want[i], want[i] == i) for i in got}


def test_linked_vectors_of_repeated_rows_and_nothing(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in linked_vectors(df).collect())
    assert got == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)]
    assert linked_vectors(df.where("vec_id > 5")).count() == 0


def test_rotation_keeps_distances():
    x = np.random.default_rng(0).normal(size=(7, 20))
    z = rotated(x)
    assert np.allclose(((x[:, None] - x[None]) ** 2).sum(-1), ((z[:, None] - z[None]) ** 2).sum(-1))
    assert np.array_equal(rotated(x[3:4])[0], z[3])

def at_cosine(g, x, c):
    """A unit vector at this cosine to each row."""
    u = x / np.linalg.norm(x, axis=1)[:, None]
    r = g.normal(size=x.shape)
    r -= (r * u).sum(1)[:, None] * u
    return c * u + np.sqrt(1 - c * c) * r / np.linalg.norm(r, axis=1)[:, None]


@pytest.mark.parametrize("options", [{"all_pairs": 0}, {"all_pairs": 0, "slice_bytes": 30_000, "chunk_rows": 50}])
def test_links_found_in_tables_equal_brute_force(spark, options):
    g = np.random.default_rng(9)
    x = g.normal(size=(1500, 64))
    x[800:1000], x[1000:1200] = at_cosine(g, x[:200], 0.9501), at_cosine(g, x[200:400], 0.9499)
    x[1200:1400] = x[400] + g.normal(size=(200, 64)) * 0.12
    rows = [(i + 2000, v.tolist()) for i, v in enumerate(x)] + [(i, v) for i, v in ODD]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in linked_vectors(df, **options).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = [(int(i) + 2000, int(j) + 2000) for i, j in zip(*np.nonzero(u @ u.T >= 0.95)) if i != j] + [(906, 907), (907, 906)]
    assert sum(j == i + 800 for i, j in links if i < 2200) == 200
    want = component_of(list(got), links)
    n = {i: 0 for i in got}
    for i, _ in links:
        n[i] += 1
    assert got == {i: (n[i], want[i], want[i] == i) for i in got}


def test_a_null_id_joins_nothing_but_counts(spark):
    g = np.random.default_rng(14)
    x = g.normal(size=(3, 16))
    near = at_cosine(g, x[:1].repeat(3, 0), 0.99)
    a, b = at_cosine(g, x[1:2].repeat(2, 0), 0.97)  # near the vector without id, perhaps not to each other
    rows = [(4, near[0]), (34, near[1]), (None, near[2]), (6, a), (7, b), (None, x[1]), (9, x[2])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>").repartition(3)
    v = np.array([v / np.linalg.norm(v) for _, v in rows])
    linked = v @ v.T >= 0.95
    got = sorted(str((r.vec_id, r.n_links, r.component_id)) for r in linked_vectors(df).collect())
    n = (linked.sum(1) - 1).tolist()
    assert n[:3] == [2, 2, 2]
    want = [(4, 2, 4), (34, 2, 4), (None, 2, None), (6, n[3], 6), (7, n[4], 6 if linked[3, 4] else 7), (None, n[5], None), (9, 0, 9)]
    assert got == sorted(map(str, want))


def test_vectors_are_moved_few_times(spark):
    """What the steps shuffle doesn't multiply the vectors."""
    def shuffled():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().getLocalDiskDirs()
        return {f: f.stat().st_size for d in folders for f in Path(d).rglob("shuffle_*.data")}

    g = np.random.default_rng(10)
    x = g.normal(size=(4000, 64)).astype(np.float32)
    x[:400] = x[400:800] + g.normal(size=(400, 64)).astype(np.float32) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    df = written(df, f"file://{tempfile.mkdtemp()}/vectors")
    before = shuffled()
    out = linked_vectors(df)
    assert out.where("n_links = 1").count() == 800
    moved = sum(n for f, n in shuffled().items() if before.get(f) != n)
    assert moved < 4 * x.nbytes


def test_rows_of_a_code_are_joined_as_by_brute_force():
    g = np.random.default_rng(11)
    x = g.normal(size=(900, 32))
    x[:500] = x[0] + g.normal(size=(500, 32)) * 0.05  # one group of many, one chain, others alone
    for i in range(501, 560):
        x[i] = at_cosine(g, x[i - 1 : i], 0.97)[0]
    x = x[g.permutation(900)]
    q, step, off = short_copies(x)
    reach = np.sqrt(0.1) + 2 * off.max()
    v = q * step[:, None].astype(float)
    a, b = np.nonzero(((v[:, None] - v[None]) ** 2).sum(-1) <= reach * reach)
    want = np.arange(900)
    merge(want, a, b)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    assert set(zip(*np.nonzero(u @ u.T >= 0.95))) <= set(zip(a, b))
    for join in (lambda n: n.same_codes(np.zeros(900, np.uint32)), lambda n: [n.turns(k, 3) for k in range(3)],
                 lambda n: [n.same_codes(np.full(900, k, np.uint32)) for k in range(2)]):
        near = Near(q, step, reach)
        join(near)
        assert near.roots(np.arange(900)).tolist() == want.tolist()
    codes = g.integers(0, 40, 900).astype(np.uint32)  # runs too short for blocks
    near = Near(q, step, reach)
    near.same_codes(codes)
    merge(label := np.arange(900), a[codes[a] == codes[b]], b[codes[a] == codes[b]])
    assert near.roots(np.arange(900)).tolist() == label.tolist()


@pytest.mark.parametrize("rows", [70_000, 3_000_000, 200_000_000])
def test_tables_miss_next_to_nothing(rows):
    meet = 1 - np.arccos(0.95) / np.pi
    tables = Tables.chosen(rows, 64, meet, np.full(100, 0.5), SLICE_BYTES)
    assert tables.missed(meet) <= MISSED and rows * 64 <= SLICE_BYTES << tables.outer
    g = np.random.default_rng(12)
    x = g.normal(size=(4000, 64))
    y = at_cosine(g, x, 0.95)
    same = (sides(x.astype(np.float32), planes(64, 16 * 5, 0, 1), 5) == sides(y.astype(np.float32), planes(64, 16 * 5, 0, 1), 5)).mean()
    assert abs(same - meet**5) < 0.02


@pytest.mark.parametrize("weights", [False, True])
def test_exact_links_of_chunks(weights):
    g = np.random.default_rng(13)
    x = g.normal(size=(1300, 24))
    x[:700] = x[0] + g.normal(size=(700, 24)) * 0.2
    w = g.integers(1, 4, 1300) if weights else np.ones(1300, dtype=np.int64)
    joins = g.random(1300) > 0.1
    u = x / np.linalg.norm(x, axis=1)[:, None]
    all_links = np.triu(u @ u.T >= 0.95, 1)
    for chunk in (np.zeros(1300, dtype=np.int64), g.integers(3, 5, 1300)):
        some = all_links & (chunk[:, None] != chunk[None]) if chunk.any() else all_links
        linked, label = exact_links(x, w, joins, chunk, 0.95)
        assert linked.tolist() == ((some | some.T) @ w).tolist()
        want = np.arange(1300)
        merge(want, *np.nonzero(some & joins[:, None] & joins[None]))
        assert label.tolist() == want.tolist()


@pytest.mark.parametrize("options", [{}, {"pivots": 5, "group_queries": 4, "block_rows": 30}])
def test_top_k_equals_brute_force(spark, options):
    x = vectors(2, 130, 10) * 0.3
    x[40:60] = x[40]
    odd = [(v[0], v[1][:10] if v[1] else v[1]) for v in ODD if v[0] != 904] + [(904, [1.0, None])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + odd, "vec_id long, embedding array<float>").repartition(4)
    got = [tuple(r) for r in top_k(df, df.where("vec_id % 20 = 0"), k=7, **options).orderBy("query_id", "rank").collect()]
    held = {i: [int(np.floor(64 * float(c))) for c in v] for i, v in enumerate(x)}
    held |= {901: [], 902: [0] * 10, 906: [64, 128], 907: [128, 256]}
    want = []
    for q in sorted(i for i in held if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(held[q], v)), i) for i, v in held.items() if i != q)[:7]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == want


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [0.5]), (1, [1.0]), (20, [-1.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in top_k(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2048), (0, 2, 20, -2048), (20, 1, 0, -2048), (20, 2, 1, -4096)]
    assert top_k(df.limit(0), df).count() == 0
    assert integer_vectors(df.select("vec_id", F.lit(None).cast("array<double>").alias("embedding")), 64).count() == 0


@pytest.mark.parametrize("options", [{}, {"pivots": 3, "group_queries": 5, "block_rows": 20}])
def test_top_k_of_numbers_of_any_size(spark, options):
    x = vectors(4, 90, 5).astype(np.float64)
    x[3], x[7], x[11, 0], x[13, 1], x[20, 2], x[31] = 2.0e7, 4.0e7, 4.0e7, -3.4e7, 1e160, -1e7
    x[40:50] *= 2.0**28
    x[50, 4], x[60, 4] = 1e308, -1e308
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = [tuple(r) for r in top_k(df, df.where("vec_id % 10 = 0 or vec_id in (3, 7, 11)"), k=6, **options).orderBy("query_id", "rank").collect()]
    held = [[int(np.floor(max(-1e300, min(1e300, 64 * float(c))))) for c in v] for v in x]
    want = []
    for q in sorted({*range(0, 90, 10), 3, 7, 11}):
        scores = [(max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(held[q], v)))), i) for i, v in enumerate(held) if i != q]
        want += [(q, k + 1, i, s) for k, (s, i) in enumerate(sorted(scores, key=lambda r: (-r[0], r[1]))[:6])]
    assert got == want


def test_partners_far_apart_in_a_crowded_run_are_candidates(spark, tmp_path):
    g = np.random.default_rng(5)
    x = g.integers(1, 255, (3000, texts.HASHES), dtype=np.uint8)
    step = texts.HASHES // texts.TREES
    for k in range(3):
        x[:, k::step] = 0
    x[1] = x[0]
    x[0, 3::step], x[1, 3::step] = 0, 255
    members = spark.createDataFrame([(i, i, bytearray(v.tobytes())) for i, v in enumerate(x)], "rep long, label long, signature binary")
    got = texts.candidate_links(members, 0.85, 4, str(tmp_path)).collect()
    assert [(r.a, r.b) for r in got] == [(0, 1)]


def test_pairs_displaced_by_a_link_that_fails_are_confirmed(spark, monkeypatch):
    line = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(line)), (2, " ".join("b" + w for w in line)), (3, " ".join([*line, "end"])), (4, " ".join("d" + w for w in line))]
    honest = texts.signed_documents
    monkeypatch.setattr(texts, "signed_documents", lambda docs, length: honest(docs, length).withColumn(
        "signature", F.lit(bytes(texts.HASHES))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(df, 3, 85).collect()} == {1: 1, 2: 2, 3: 1, 4: 4}


def test_top_k_of_a_query_whose_copies_outnumber_k(spark):
    g = np.random.default_rng(9)
    x = g.normal(size=(200, 6))
    long = [9.0, 9.0, 9.0, 9.0, 9.0, 9.0]
    rows = [(1000, long)] * 30 + [(i + 1, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = [(r["rank"], r.vec_id, r.score) for r in top_k(df, df.where("vec_id = 1000"), k=20, pivots=300).orderBy("rank").collect()]
    scores = sorted((-sum(576 * int(np.floor(64 * c)) for c in v), i + 1) for i, v in enumerate(x))[:20]
    assert got == [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]


def links_of(sets, percent):
    return [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) > 0]


@pytest.mark.parametrize("parts", [1, 2])
def test_links_of_a_cell_equal_brute_force(parts, monkeypatch):
    r = random.Random(parts)
    monkeypatch.setattr(texts, "GATHERED", 50)
    base = [r.randrange(1 << 40) for _ in range(60)]
    sets = [{x if r.random() < 0.93 else r.randrange(1 << 40) for x in base[: r.randrange(20, 60)]} for _ in range(70)] + [{1}, {1}, {2, 3}]
    label, part = np.array([i // 2 for i in range(73)]), np.array([i % parts for i in range(73)])
    found = list(texts.shared_links([np.array(sorted(s), dtype=np.uint64) for s in sets], label, part, 80))
    true = {(b, a) for a, b in links_of(sets, 80) if part[a] != part[b] or parts == 1}
    assert set(found) <= true and len(found) < 73
    same = [(i, i + 1) for i in range(0, 72, 2)]
    assert component_of(range(73), found + same) == component_of(range(73), list(true) + same)


def test_a_crowded_region_near_the_threshold_equals_brute_force(spark, monkeypatch):
    """One template; most documents are just below the threshold to each other, planted ones just above."""
    monkeypatch.setattr(texts, "REGION_ROWS", 16)
    monkeypatch.setattr(texts, "PART_ROWS", 24)
    r = random.Random(12)
    line = [f"t{i}" for i in range(160)]

    def varied(base, changes):
        out = list(base)
        for i in r.sample(range(len(base)), changes):
            out[i] = f"x{r.randrange(1 << 30)}"
        return out

    written = [varied(line, r.randrange(3, 7)) for _ in range(260)]
    written += [varied(w, 3) for w in written[:60]] + [varied(w, 1) for w in written[60:80]]
    rows = [(i, " ".join(w)) for i, w in enumerate(written)]
    got = {x.doc_id: x.component_id for x in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85).collect()}
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in written]
    links = links_of(sets, 85)
    assert len(links) > 60 and got == component_of(range(len(sets)), links)
    assert 50 < len(set(got.values()))


def test_a_component_of_many_does_not_meet_itself(spark, monkeypatch):
    monkeypatch.setattr(texts, "PART_ROWS", 8)
    r = random.Random(13)
    line = [f"t{i}" for i in range(200)]
    near = [[*line[:i], f"n{i}", *line[i + 1 :]] for i in range(0, 120)]
    far = [[w if k % 14 else f"f{j}-{k}" for k, w in enumerate(line)] for j in range(12)]
    rows = [(i, " ".join(w)) for i, w in enumerate(near + far)]
    r.shuffle(rows)
    got = {x.doc_id: x.component_id for x in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85).collect()}
    sets = [{tuple(w[k : k + 3]) for k in range(len(w) - 2)} for w in near + far]
    assert got == component_of(range(len(sets)), links_of(sets, 85))


def test_rows_of_one_id_link_by_any_of_their_texts(spark):
    line = " ".join(f"w{i}" for i in range(50))
    other = " ".join(f"v{i}" for i in range(50))
    rows = [(1, line), (2, line + " end"), (2, other), (3, other + " end"), (2, other)]
    got = {(x.doc_id, x.component_id) for x in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}
