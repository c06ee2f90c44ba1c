"""Connected components of an edge table, by contraction and pointer jumping.

Every slice of a task's edges is contracted first. Edges that then fill no more than one slice are settled by contracting
that slice, without a shuffle. More edges point from a node to a smaller one, and are settled in rounds until they are few
enough. A round does this:

1. Every slice of a task's edges is contracted to stars around the least node of each local component, so that a node
   has one edge a slice, however many it had before.
2. Every node, and its other smaller neighbours, are hung under the least of these by a window over its edges. A node
   has at most one edge a slice here: no key is hot.
3. Nodes that are pointed at and point on themselves are found by one grouped minimum with map-side combine. When there
   are none, and no node points twice, the edges are the components. Otherwise whoever points at such a node is made to
   point where it points; the join that does so is a broadcast of checked size, or may be split by Spark.

Edges are written to the shared folder after each round, so lineage stays short and a lost executor costs one round at
most. Two numbers a round reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidehouse import session, sized
from tidehouse.llm import arrow

MAX_ROUNDS = 60
#: Edges that are contracted at once, 16 bytes each.
SLICE = 1_000_000

_EDGES = "u long, v long"
_EDGES_ARROW = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def local_stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to (node, least node reachable), for every node that is not itself the least."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    parent = np.arange(len(ids))
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(parent, high[apart], low[apart])
        while True:
            jumped = parent[parent]
            if (jumped == parent).all():
                break
            parent = jumped
    child = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[child], ids[parent[child]]


def _contract(batches):
    """Edges to stars, a slice at a time."""
    held: list[pa.RecordBatch] = []

    def stars():
        u, v = (np.concatenate([part.column(n).to_numpy() for part in held]) for n in ("u", "v"))
        return arrow.batch(_EDGES_ARROW, *local_stars(u, v))

    for part in batches:
        held.append(part)
        if sum(x.num_rows for x in held) >= SLICE:
            yield stars()
            held.clear()
    if held:
        yield stars()


def _least(edges: DataFrame) -> DataFrame:
    """Each node, and its other neighbours, below its least neighbour."""
    near = Window.partitionBy("u").orderBy("v")
    ranked = edges.select("u", "v", F.first("v").over(near).alias("m"), F.row_number().over(near).alias("rank"))
    return ranked.where("rank = 1 or v <> m").select(F.when(F.col("rank") == 1, F.col("u")).otherwise(F.col("v")).alias("u"),
                                                     F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """Edges ``u, v`` (longs) to ``id, component``: the least node reachable, for every node that is not itself the least."""
    spark = edges.sparkSession

    def stored(df: DataFrame, what: str, schema: str) -> DataFrame:
        path = session.shared_dir(spark, what)
        df.write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    current = known = stored(edges.where("u <> v").select("u", "v").mapInArrow(_contract, _EDGES), "edges", _EDGES)
    for _ in range(MAX_ROUNDS):
        if known.count() <= SLICE:  # jumps change no number of edges
            stars = stored(current.coalesce(1).mapInArrow(_contract, _EDGES), "edges", _EDGES)
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
        current = known = stored(_least(current.mapInArrow(_contract, _EDGES)), "edges", _EDGES)
        ends = current.select(F.col("u").alias("id"), F.col("v").alias("m"), F.lit(False).alias("met")).unionByName(
            current.select(F.col("v").alias("id"), F.lit(None).cast("long").alias("m"), F.lit(True).alias("met")))
        state = ends.groupBy("id").agg(F.min("m").alias("m"), F.count("m").alias("n"), F.max("met").alias("met"))
        loose = stored(state.where("n > 1 or n = 1 and met"), "loose", "id long, m long, n long, met boolean")
        several, on = loose.agg(F.count_if(F.col("n") > 1), F.count_if("met")).first()
        if not several and not on:
            return current.select(F.col("u").alias("id"), F.col("v").alias("component"))
        if on:
            jumps = sized.small_side(loose.where("met").select(F.col("id").alias("v"), "m"))
            current = current.join(jumps, "v", "left").select("u", F.coalesce("m", "v").alias("v"))
    raise RuntimeError("components did not settle")
