"""Every registered query against its SQL."""

import importlib.util
import os

import pytest

import oracle

HERE = os.path.dirname(os.path.abspath(__file__))
spec = importlib.util.spec_from_file_location("entry_module", os.path.join(HERE, "..", "__spark_entry__.py"))
entry_module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_module)

QUERIES, SQL = entry_module.catalog.QUERIES, entry_module.catalog.SQL


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    assert oracle.difference(df, con, SQL[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
