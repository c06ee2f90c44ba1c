"""Stretches of the language network against a plain forward pass, position by position."""

from __future__ import annotations

import os

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidehouse.llm import language


def plain(net: language.ByteNetwork, text: bytes) -> np.ndarray:
    """Mean over all bytes; each is labelled by the first stretch that gives it its context, or by the last one."""
    n, total = len(text), np.zeros(len(net.languages))
    stride = language.SPAN - 2 * language.CONTEXT
    done, start = 0, 0
    while done < n:
        last = start + language.SPAN >= n
        begin = max(0, n - language.SPAN) if last else start
        stretch = text[begin:begin + language.SPAN]
        stretch += b" " * (-len(stretch) % language.FILL)
        ids = np.frombuffer(stretch, np.uint8).astype(np.intp)[:, None]
        both = np.concatenate([net._run("f", ids), net._run("b", ids[::-1])[::-1]], axis=2)[:, 0]
        score = np.exp(both @ net.p["out"] + net.p["out_b"])
        label = score / score.sum(1, keepdims=True)
        upto = n if last else start + language.SPAN - language.CONTEXT
        total += label[done - begin:upto - begin].sum(0)
        done, start = upto, start + stride
    return total / n


@pytest.mark.parametrize("hidden", [3, language.HIDDEN])
def test_means_equal_a_plain_pass(hidden):
    net, rng = language.ByteNetwork(["a", "b", "c"], hidden=hidden), np.random.default_rng(4)
    lengths = [1, 2, 31, 32, 33, 64, 255, 256, 257, 272, 479, 480, 481, 482, 700, 704, 705, 5000, 1, 256]
    texts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in lengths]
    assert np.allclose(net.means(texts), [plain(net, t) for t in texts], atol=1e-5)


def test_blanks_and_neighbours_count():
    """State crosses blanks: what stands beside a word changes its labels."""
    net = language.ByteNetwork(["a", "b"])
    ids = [np.frombuffer(t, np.uint8).astype(np.intp)[:, None] for t in (b"same word", b"diff word")]
    one, two = (net.probabilities(i)[5:, 0] for i in ids)
    assert one.shape == (4, 2) and not np.allclose(one, two, atol=1e-6)


def test_short_texts_held_out(spark):
    """Accuracy on the first bytes of held-out texts."""
    docs = spark.read.parquet(f"{os.path.dirname(SMALL)}/sf0.01/documents.parquet")
    model = language.train(docs)
    held = docs.where(language.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.octet_length("text") >= 200))
    for cut, least in ((16, 0.9), (64, 0.96), (10_000, 0.98)):
        rows = language.languages_of(held.withColumn("text", F.substring("text", 1, cut)), model, ["lang"]).collect()
        named = [r for r in rows if r.lang_pred != "und"]
        assert len(named) > 100 and sum(r.lang == r.lang_pred for r in named) >= least * len(named), cut
