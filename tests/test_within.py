"""The last match within a bound of time."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidehouse.operators.within import last_within, with_match


def tables(spark, n, keys, span, seed=0, hot=0):
    chance = random.Random(seed)

    def rows(count):
        out = [(i, chance.choice(keys), chance.randrange(span)) for i in range(count)]
        return out + [(count + i, "hot", chance.randrange(span)) for i in range(hot)] + [(-1, "a", None)]

    left, right = rows(n), rows(n)
    frames = [spark.createDataFrame(r, f"{p}_id int, {p}_key string, s int").select(
        f"{p}_id", f"{p}_key", F.timestamp_seconds("s").alias(f"{p}_time")) for r, p in ((left, "l"), (right, "r"))]
    return left, right, frames


@pytest.mark.parametrize("within", [0, 1, 7, 1000])
def test_against_all_pairs(spark, within):
    left, right, (a, b) = tables(spark, 300, ["a", "b", "c", None], 200, within)
    got = {r.l_id: r.r_id for r in with_match(last_within(
        a, b, ("l_key", "r_key"), ("l_time", "r_time"), within * 1_000_000, ["r_id"]), b.columns).where("l_id >= 0").collect()}
    want = {}
    for i, key, at in left[:-1]:
        near = [(t, j) for j, k, t in right if key is not None and k == key and t is not None and abs(t - at) <= within]
        want[i] = max(near)[1] if near else None
    assert got == want


def test_a_hot_key_makes_no_pairs(spark):
    left, right, (a, b) = tables(spark, 0, [], 3_000, 1, hot=6_000)
    found = last_within(a, b, ("l_key", "r_key"), ("l_time", "r_time"), 60_000_000, ["r_id"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "collect_" not in text
    met = with_match(found, b.columns, inner=True)
    assert met.count() == met.select("l_id").distinct().count() == sum(
        any(k == "hot" and t is not None and abs(t - at) <= 60 for _, k, t in right) for _, key, at in left[:-1])
