"""The registered queries: SQL parity on the smallest tables, and whole results."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check import digest, duck  # noqa: E402

from tidemark.llm.queries import ORACLE, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SMALL)
    res = duck(SMALL).execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(res.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_one_row_or_more_per_document(spark, name):
    ids = {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in QUERIES[name](spark, SMALL).select("doc_id").collect()} == ids


def test_held_out_quality_on_the_given_tables(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").collect() if r.held_out and docs[r.doc_id]]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) > 0.95 * len(held)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [r for r in QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.01").collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) > 0.9 * len(held)


def test_ids_divide_the_queries(spark):
    top = QUERIES["op1_exact_top_k"](spark, SMALL).collect()
    assert {r.query_id % 50 for r in top} == {0} and {r["rank"] for r in top} == set(range(1, 6))
    near = QUERIES["op2_block_matrix_neighbours"](spark, SMALL).collect()
    assert {r.query_id % 20 for r in near} == {0} and {r["rank"] for r in near} == set(range(1, 21))
