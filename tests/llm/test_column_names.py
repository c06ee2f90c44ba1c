"""Columns whose names are no plain words go through the stages unharmed, and the trie's budget counts its nodes."""

from __future__ import annotations

import corpus_pipeline
from conftest import SMALL

from tidehouse.llm import exact_copies

NAMES = "doc_id long, `a.b` string, text string, lang string, `x``y` long"


def test_stages_keep_odd_columns(spark):
    rows = [(None, "0", "no number here at all", "en", 0), (1, "1", "same words in both", "en", 1), (2, "2", "same words in both", None, 2),
            (2, "2", "same words in both", None, 2), (3, "3", None, "de", 3), (4, "4", "other words are here", "de", 4)]
    docs = spark.createDataFrame(rows, NAMES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SMALL)
        assert left.schema.names == docs.schema.names, name
        found = {r[1] for r in left.collect()}
        assert name == "language" or {"0", "4"} <= found, name  # too few texts to learn a language from
        assert stage(spark, docs.limit(0), SMALL).collect() == [], name
    assert {r[1] for r in corpus_pipeline.exact_stage(spark, docs, SMALL).collect()} == {"0", "2", "3", "4"}


def test_a_trie_of_many_short_texts_spills(tmp_path):
    trie = exact_copies.PatriciaTrie(budget=1 << 16, folder=str(tmp_path))
    for n in range(5000):
        trie.insert(n.to_bytes(4, "big"), n)
    assert trie._files > 0 and trie._bytes < 1 << 18
    assert sorted(text for text, _ in trie.terminals()) == [n.to_bytes(4, "big") for n in range(5000)]
