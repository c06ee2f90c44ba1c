"""Components against a plain union of sets."""

import random

import numpy as np

from tidehouse.llm import components


def plain(edges):
    label = {}

    def root(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        label[max(a, b)] = min(a, b)
    return {x: root(x) for x in label if root(x) != x}


def graphs():
    rng = random.Random(5)
    shuffled = list(range(1, 400))
    rng.shuffle(shuffled)
    yield "path", [(i, i + 1) for i in range(300)]
    yield "shuffled path", list(zip(shuffled, shuffled[1:], strict=False))
    yield "star with a greatest centre", [(9999, i) for i in range(500)] * 2
    yield "zigzag", [(100 + i, i) for i in range(80)] + [(100 + i, i + 1) for i in range(80)]
    yield "random", [(rng.randrange(600), rng.randrange(600)) for _ in range(450)] + [(7, 7), (-5, 3)]
    yield "empty", []


def test_components(spark):
    for name, edges in graphs():
        table = spark.createDataFrame(edges, "u long, v long").repartition(7)
        rows = components.components(table).collect()
        assert {r.id: r.component for r in rows} == plain(edges), name
        assert len(rows) == len({r.id for r in rows}), name


def test_slices(monkeypatch):
    monkeypatch.setattr(components, "SLICE", 3)
    rows = [(9, 1), (9, 2), (9, 4), (9, 4), (9, 7), (8, 3), (8, 6), (10, 5)]
    batches = [components.arrow.batch(components._EDGES_ARROW, [u], [v]) for u, v in rows]
    out = [(u, v) for b in components._contract(iter(batches)) for u, v in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert plain(out) == plain(rows) and all(v < u for u, v in out)
    u, v = components.local_stars(np.array([3, 5, 5]), np.array([1, 3, 4]))
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {3: 1, 4: 1, 5: 1}


def test_rounds_and_one_slice(spark, monkeypatch):
    """Edges beyond a slice are settled in rounds; what fits one slice takes no shuffle by node and no round."""
    tables = []
    least = components._least
    monkeypatch.setattr(components, "_least", lambda edges: tables.append(edges) or least(edges))
    for name, edges in graphs():
        table = spark.createDataFrame(edges, "u long, v long").repartition(7)
        for size, rounds in ((20, len(edges) > 100), (1_000_000, False)):
            monkeypatch.setattr(components, "SLICE", size)
            tables.clear()
            rows = components.components(table).collect()
            assert {r.id: r.component for r in rows} == plain(edges), (name, size)
            assert len(rows) == len({r.id for r in rows}), (name, size)
            assert bool(tables) == rounds, (name, size)
