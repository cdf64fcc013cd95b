"""Registered queries: their SQL twins, their columns, and the guard around the subpackage."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from countypanel.llm import queries

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_warc_members": "page_id payload_bytes payload_digest record_type refers_to",
    "op2_disclosure_spans": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3_toxicity": "doc_id held_out score predicted",
    "op4_voronoi_top_k": "query_id rank vec_id score",
    "op5_vector_near_dedup": "vec_id n_links component_id kept",
    "op6_best_fit_packing": "doc_id source cluster size piece first words bin place room",
    "op7_url_rules": "page_id host path rule verdict",
    "op8_lsh_forest": "doc_id n_shingles component_id kept",
    "op9_backoff_scores": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op10_source_mix": "doc_id source size source_size target taken",
    "op11_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_collision_search": "query_id rank vec_id score",
    "op13_gnat_codes": "vec_id code error label_error codebooks_sha256",
}
TABLE_OF = {"op1_warc_members": "pages", "op7_url_rules": "pages", "op5_vector_near_dedup": "embeddings", "op13_gnat_codes": "embeddings"}
PER_ROW = [n for n in COLUMNS if n not in ("op4_voronoi_top_k", "op6_best_fit_packing", "op12_collision_search")]


def test_each_operator_has_one_query():
    names = list(entry_points.queries())
    assert [n for n in COLUMNS if n in names] == list(COLUMNS)
    assert [int(re.match(r"op([0-9]+)_", n)[1]) for n in queries.registered()] == list(range(1, 14))
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "privacy", "mixture", "packing"]


@pytest.mark.parametrize("name", list(queries.statements()))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    twin = database.sql(queries.statements()[name])
    df = queries.registered()[name](spark, FOLDER)
    columns = COLUMNS[name].split()
    assert sorted(df.columns) == sorted(twin.columns) == sorted(columns)
    mine, theirs = df.select(columns).collect(), twin.project(", ".join(columns)).fetchall()
    def texts(rows):  # the last digits of a cosine depend on the order of its sum
        return sorted(str([round(x, 9) if isinstance(x, float) else x for x in row]) for row in rows)
    assert len(mine) > 0 and texts(mine) == texts(theirs)


@pytest.mark.parametrize("name", [n for n in PER_ROW if n not in queries.statements()])
def test_one_row_for_each_row(spark, name):
    df = queries.registered()[name](spark, FOLDER)
    assert df.columns == COLUMNS[name].split()
    assert df.count() == spark.read.parquet(f"{FOLDER}/{TABLE_OF.get(name, 'documents')}.parquet").count()
