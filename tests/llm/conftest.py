from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"


def passage(start: int, n: int) -> str:
    return " ".join(f"w{(start + i) * 7919 % 100003}" for i in range(n))


#: Nulls, empty and very long texts, repeats, ties, odd white space and special strings.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, WORDS), (5, WORDS), (6, WORDS.upper()), (7, "one two"), (8, "One  two\n"),
    (9, passage(0, 60)), (10, passage(0, 60) + " tail " + passage(500, 30)), (11, "x " * 60), (12, "x " * 60 + "y"),
    (13, passage(1000, 20000)), (14, "<|endoftext|> a <|endoftext|>b  <|startoftext|>"), (15, "Été naïve straße \u4e2d\u6587 \u00a0 ok"),
    (16, "don't  I'LL\r\n\x1c we've 12 ½"), (17, passage(2000, 100)), (18, passage(2000, 98) + " changed end"),
    (19, "q" * 5000), (-20, passage(3000, 25) + " " + passage(3000, 25)), (21, "..."),
]


@pytest.fixture
def edges(spark):
    """The edge texts with an extra column named like a result."""
    rows = [(d, t, "en" if d % 2 else None, "src", d * 2, "no") for d, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")


@pytest.fixture
def nothing(edges):
    return edges.limit(0)


@pytest.fixture
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
