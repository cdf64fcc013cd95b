"""The registered queries: each applies one operator to a whole table, with its SQL twin where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .codes import coded_vectors
from .collisions import nearest_neighbours
from .knn import top_k
from .lm import scored_documents
from .merkle import lower_ascii, manifest
from .mixing import Mix, with_word_counts
from .packing import pack
from .pii import BASE, KINDS, SPANS, of_kind, spans_text, with_spans
from .texts import near_duplicates
from .toxicity import fit, held_out, scored
from .urls import judge_urls
from .vectors import linked_vectors
from .warc import archive_round_trip


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    return archive_round_trip(table(spark, folder, "pages"))


def op2_disclosure_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = with_spans(table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)
    counts = [F.size(of_kind(F.col(BASE), k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col(BASE)), 256).alias("base_sha256"),
                        spans_text(F.col(SPANS)).alias("spans"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, folder, "labels"), ~held_out(5))
    return scored(docs, model).select(
        "doc_id", F.coalesce(held_out(5), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_voronoi_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64)


def op5_vector_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linked_vectors(table(spark, folder, "embeddings"), cosine=0.95)


def packing_items(docs: DataFrame) -> DataFrame:
    """Sizes in words, with exact copies as clusters."""
    marked = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("cluster"))
    return with_word_counts(marked)


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(packing_items(table(spark, folder, "documents")), capacity=2048)


RULES = "VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')"


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM {RULES} AS t(rule_host, rule_path, action)")
    return judge_urls(table(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op8_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), length=3, percent=85)


def op9_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    return scored_documents(table(spark, folder, "documents").select("doc_id", "text"), held_out(10))


def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mix = Mix(table(spark, folder, "documents"))
    return mix.taken().select("doc_id", "source", "size", "source_size", "target", "taken")


LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return manifest(documents, [F.col(c) for c in LEAF], "doc_id", F.col("lang"), presented=[*(F.col(c) for c in LEAF[:-1]), text])


def op12_collision_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op13_gnat_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = coded_vectors(table(spark, folder, "embeddings"))
    digest = books.digest() if books else hashlib.sha256(b"").hexdigest()
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_warc_members, op2_disclosure_spans, op3_toxicity, op4_voronoi_top_k, op5_vector_near_dedup, op6_best_fit_packing,
        op7_url_rules, op8_lsh_forest, op9_backoff_scores, op10_source_mix, op11_merkle_manifest, op12_collision_search,
        op13_gnat_codes)}


STATEMENTS = {
    "op1_warc_members": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
        f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to
        FROM f""",
    "op4_voronoi_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
              FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op5_vector_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                   AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
              WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
        r(vec_id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, e.b FROM r JOIN e ON r.c = e.a),
        n AS (SELECT a, count(*) AS n FROM e GROUP BY a),
        m AS (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id)
        SELECT t.vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, t.vec_id = m.c AS kept
        FROM embeddings t JOIN m USING (vec_id) LEFT JOIN n ON n.a = t.vec_id""",
    "op7_url_rules": r"""
        WITH p AS (SELECT page_id,
            translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        k(h, p, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        f AS (SELECT p.page_id, p.host, p.path, k.h || k.p AS rule, action,
              row_number() OVER (PARTITION BY page_id ORDER BY length(k.h || k.p) DESC NULLS LAST, length(k.h) DESC) AS n
              FROM p LEFT JOIN k ON (p.host = k.h OR ends_with(p.host, '.' || k.h)) AND starts_with(p.path, k.p))
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM f WHERE n = 1""",
}

STATEMENTS["op8_lsh_forest"] = r"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
    x AS (SELECT doc_id, unnest(s) AS g FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    e AS (SELECT p.a, p.b FROM p JOIN s m ON p.a = m.doc_id JOIN s n ON p.b = n.doc_id
          WHERE 100 * p.c >= 85 * (len(m.s) + len(n.s) - p.c)),
    r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a),
    m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept
    FROM s JOIN m USING (doc_id)"""

# crc32 of a decimal number's digits, bit by bit, and a value with its length.
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""
MEASURED = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
LOWER_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

STATEMENTS["op11_merkle_manifest"] = f"""
    WITH RECURSIVE d AS (SELECT doc_id, lang,
            sha256({" || ".join(MEASURED.format(c) for c in LEAF)}) AS leaf,
            CASE WHEN doc_id IS NOT NULL AND {CRC.format("doc_id")} % 3 = 0
                THEN sha256({" || ".join(MEASURED.format(c) for c in LEAF[:-1])} || {MEASURED.format(LOWER_TEXT)}) END AS shown FROM documents),
    o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
    t(lang, level, pos, h, n) AS (
        SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM o
        UNION ALL SELECT lang, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM t WHERE n > 1
        GROUP BY lang, level, pos // 8, n),
    k AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
    u(level, pos, h, n) AS (
        SELECT 0, pos, subroot, n FROM k
        UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM u WHERE n > 1 GROUP BY level, pos // 8, n),
    runs AS (SELECT lang, level, pos // 8 AS run, string_agg(h, '' ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL),
    tops AS (SELECT level, pos // 8 AS run, string_agg(h, '' ORDER BY pos) AS hs FROM u WHERE n > 1 GROUP BY ALL),
    way AS (SELECT o.lang, o.pos, false AS upper, r.level, o.pos // CAST(8 ** r.level AS BIGINT) % 8 AS place, r.hs
            FROM o JOIN runs r ON o.lang IS NOT DISTINCT FROM r.lang AND r.run = o.pos // CAST(8 ** (r.level + 1) AS BIGINT)
        UNION ALL SELECT o.lang, o.pos, true, r.level, k.pos // CAST(8 ** r.level AS BIGINT) % 8, r.hs
            FROM o JOIN k ON o.lang IS NOT DISTINCT FROM k.lang JOIN tops r ON r.run = k.pos // CAST(8 ** (r.level + 1) AS BIGINT)),
    p AS (SELECT lang, pos, list(substring(hs, 1, 64 * place) ORDER BY upper, level) AS l, list(substring(hs, 64 * place + 65) ORDER BY upper, level) AS r,
            string_agg(substring(hs, 1, 64 * place) || substring(hs, 64 * place + 65), '' ORDER BY upper, level) AS proof FROM way GROUP BY lang, pos),
    f(lang, pos, step, h) AS (SELECT lang, pos, 0, coalesce(shown, leaf) FROM o
        UNION ALL SELECT f.lang, f.pos, step + 1, sha256(p.l[step + 1] || h || p.r[step + 1])
            FROM f JOIN p ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos WHERE step < len(p.l)),
    e AS (SELECT lang, pos, arg_max(h, step) AS folded FROM f GROUP BY lang, pos)
    SELECT o.doc_id, o.leaf, k.subroot, z.h AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, e.folded AS folded_root, e.folded = z.h AS verified
    FROM o JOIN k ON o.lang IS NOT DISTINCT FROM k.lang JOIN e ON o.lang IS NOT DISTINCT FROM e.lang AND o.pos = e.pos
        LEFT JOIN p ON o.lang IS NOT DISTINCT FROM p.lang AND o.pos = p.pos, (SELECT h FROM u WHERE n = 1) z"""

STATEMENTS["op12_collision_search"] = """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
               AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    s AS (SELECT q.vec_id AS query_id, d.vec_id, list_cosine_similarity(q.v, d.v) AS score
          FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

NEAREST_ENTRY = """a{n} AS (SELECT r, p, min(64 * list_sum(list_transform(range(1, len(s.x) + 1), lambda i: (s.x[i] - b.x[i]) * (s.x[i] - b.x[i]))) + e) AS m
        FROM s JOIN b{n} b USING (p) GROUP BY r, p)"""
MOVED_ENTRY = """c{n} AS (SELECT p, m % 64 AS e, i, sum(x[i]) AS t, count(*) AS c FROM a{n} JOIN s USING (r, p), range(1, 5) g(i) GROUP BY 1, 2, 3),
    b{next} AS (SELECT b.p, b.e, coalesce(w.x, b.x) AS x FROM b{n} b LEFT JOIN (
        SELECT p, e, list(CAST((t - ((t % c) + c) % c) // c AS BIGINT) ORDER BY i) AS x FROM c{n} GROUP BY p, e) w USING (p, e))"""

STATEMENTS["op13_gnat_codes"] = f"""
    WITH v AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS r,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT r, p, v[4 * p + 1 : 4 * p + 4] AS x FROM v, range(16) g(p)),
    b0 AS (SELECT p, r AS e, x FROM s WHERE r < 64),
    {NEAREST_ENTRY.format(n=0)}, {MOVED_ENTRY.format(n=0, next=1)},
    {NEAREST_ENTRY.format(n=1)}, {MOVED_ENTRY.format(n=1, next=2)},
    {NEAREST_ENTRY.format(n=2)},
    d AS (SELECT r, string_agg(format('{{:02x}}', CAST(m % 64 AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error FROM a2 GROUP BY r),
    h AS (SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY p, e)) AS h FROM b2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h.h AS codebooks_sha256 FROM v JOIN d USING (r), h"""


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
