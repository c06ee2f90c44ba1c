"""What the pipeline's language stage drops and keeps."""

from __future__ import annotations

import functools
import random

import corpus_pipeline

from tidehouse.llm import language

SCHEMA = "doc_id long, text string, lang string"


def test_unlabelled_corpus_is_kept(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "123 ...", None), (3, None, None), (4, "слова", None)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.language_stage(spark, docs, "").collect()) == [1, 4]


def test_network_drops_junk_of_two_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "train", functools.partial(language.train, steps=80))
    rng = random.Random(3)

    def words(letters, n=40):
        return ["".join(rng.choice(letters) for _ in range(6)) for _ in range(n)]

    one, two = "abcdefgh", "stuvwxyz"
    clean = [(i, " ".join(words(one if i % 2 else two)), "one" if i % 2 else "two") for i in range(40)]
    junk = [(100, " ".join(w for pair in zip(words(one), words(two)) for w in pair), None)]
    docs = spark.createDataFrame(clean + junk, SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, "").collect()} == set(range(40))


def test_one_language_is_kept(spark, monkeypatch):
    monkeypatch.setattr(language, "train", functools.partial(language.train, steps=3))
    docs = spark.createDataFrame([(i, "some words", "one") for i in range(8)], SCHEMA)
    assert corpus_pipeline.language_stage(spark, docs, "").count() == 8
