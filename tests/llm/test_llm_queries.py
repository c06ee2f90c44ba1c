"""Registered queries against their SQL, and the pipeline against plain Python."""

from __future__ import annotations

import collections

import brute
import corpus_pipeline
import duckdb
import pytest
from conftest import SMALL

from tidehouse.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    want = db.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert collections.Counter(map(tuple, got.select(columns).collect())) == collections.Counter(want.fetchall())


def test_pipeline_keeps_what_it_should(spark):
    packed = {r.doc_id for r in corpus_pipeline.run(spark, SMALL).select("doc_id").distinct().collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    last = {}
    for d, t in docs.items():
        last[t] = max(d, last.get(t, d))
    left = [(d, docs[d]) for d in last.values() if any(c.isalpha() for c in docs[d])]
    kept = {d for d, v in brute.near_copies(left).items() if v[2]}
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert packed == {d for d, v in brute.contamination([(d, docs[d]) for d in kept], items).items() if not v[4]}
