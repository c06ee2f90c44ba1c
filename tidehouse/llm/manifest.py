"""A Merkle manifest of a dataset: a tree of digests per group, a tree over the groups, and a proof for every row.

Rows of a group are ranked, and the rank's base-8 digits are columns. Blocks of 512 consecutive nodes are rolled up by
grouping the digits away one after another, lowest first: each time up to eight children become one struct that holds
their digest and, nested, the children themselves. A block lands in one task whole by one shuffle, so the three groupings
need no other. The blocks' own digests are the nodes of the next roll-up, until a group is a single block; the groups'
digests (subroots) are ranked and rolled up the same way.

Proofs come down the same nested structs: a transform gives every child the digests before and after it in its run, an
explode makes it a row, three times per block, with the path so far carried along. A block gets the path of its own
digest by being grouped with it, two rows to a group. Nothing is joined but the ranks' offsets, one row per group and
partition. No group of rows is gathered beyond a block of 512, whatever a group's size.

Ranks come from a written table sorted by ranges, so a lost executor cannot change them.

Defined results: nulls are digested as ``-``; a null group is a group of its own and comes first; a null identifier comes
first in its group; rows with equal identifiers are ordered by their digest, and equal rows are leaves of their own; a
group of one row is its own subroot, one group's subroot the root; an empty table gives no rows. Texts of any length are
digested in one piece. Names of other columns do not matter: only the named ones are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidehouse import session
from tidehouse.llm import arrow

#: Children of a node, and digits grouped away per block: 512 nodes.
FAN, DIGITS = 8, 3
BLOCK = FAN ** DIGITS
#: Height of the tree of as many rows as a 64-bit count can have.
HIGHEST = 20

#: The columns that make a document's leaf, in order.
DOCUMENT = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<left:string,right:string>"


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: every value with its length in bytes before it, ``-`` for null."""
    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*map(framed, values)))


def fold(node: Column, proof: Column) -> Column:
    """The root that a leaf's digest and the siblings of its proof lead to."""
    return F.aggregate(proof, node, lambda so_far, step: digest(F.concat(step["left"], so_far, step["right"])))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""))


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    path = session.shared_dir(rows.sparkSession, f"manifest-{purpose}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with their place in their group ``_g`` and the group's size; ``order`` sorts within a group."""
    order = (F.col("_g").asc_nulls_first(), *order)
    placed = _written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}), "ranks")
    runs = placed.groupBy("_g", "_part").agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_g")  # as many rows as a group has partitions
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("_g").alias("_run_g"), F.col("_part").alias("_run_part"), F.sum("_n").over(group).alias("_size"),
                       (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start")).alias("_shift"))
    here = (F.col("_part") == F.col("_run_part")) & F.col("_g").eqNullSafe(F.col("_run_g"))
    return placed.join(runs, here).withColumn("_rank", F.col("_at") + F.col("_shift")).drop(
        "_at", "_part", "_run_g", "_run_part", "_shift")


def _rolled(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Blocks ``_g, _block, _height, _size, _kids, _node`` of nodes ``_g, _rank, _size, _node`` and their payload.

    ``_height`` is how many levels of the group's tree are left; a grouping beyond it passes its only child's digest on.
    """
    height = F.expr(f"size(filter(sequence(0, {HIGHEST}), k -> _size > shiftleft(1L, 3 * k)))")
    digits = [F.shiftright("_rank", 3 * k).bitwiseAND(F.lit(FAN - 1)).alias(f"_d{k}") for k in range(DIGITS)]
    rows = nodes.select("_g", F.shiftright("_rank", 3 * DIGITS).alias("_block"), "_size", height.alias("_height"), "_node",
                        *digits, *payload).repartition("_g", "_block")
    child = F.struct("_d0", "_node", *payload)
    for level in range(DIGITS):
        keys = ["_g", "_block", "_height", "_size", *(f"_d{k}" for k in range(DIGITS - 1, level, -1))]
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(child)).alias("_kids"))
        one = digest(F.array_join(F.transform("_kids", lambda kid: kid["_node"]), ""))
        rows = rows.withColumn("_node", F.when(F.col("_height") > level, one).otherwise(F.col("_kids")[0]["_node"]))
        child = F.struct(f"_d{level + 1}", "_node", "_kids")
    return rows


def _climbed(nodes: DataFrame, payload: Sequence[str] = ()) -> list[DataFrame]:
    """Blocks of all levels; those of the last hold a whole group each, and their digest is the group's."""
    levels = []
    while True:
        blocks = _written(_rolled(nodes, payload), "blocks")
        levels.append(blocks)
        most = blocks.agg(F.max("_size")).first()[0]
        if most is None or most <= BLOCK:
            return levels
        parents = F.shiftright(F.col("_size") + (BLOCK - 1), 3 * DIGITS)
        nodes, payload = blocks.select("_g", F.col("_block").alias("_rank"), parents.alias("_size"), "_node"), ()


def _handed_down(levels: list[DataFrame], above: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Nodes of the lowest level with ``_tops`` and ``_path``, from those of the last level's blocks (``_g, _block``)."""
    for depth in range(len(levels) - 1, -1, -1):
        blocks = levels[depth].drop("_node", "_size")
        both = blocks.unionByName(above, allowMissingColumns=True)
        met = both.groupBy("_g", "_block").agg(*(F.collect_list(c)[0].alias(c) for c in ("_height", "_kids", "_tops", "_path")))
        rows = met.withColumn("_rank", F.col("_block"))
        for level in range(DIGITS - 1, -1, -1):
            names = F.transform("_kids", lambda kid: kid["_node"])
            steps = F.transform("_kids", lambda kid, i: F.struct(
                kid.alias("kid"), F.array_join(F.slice(F.col("_names"), 1, i), "").alias("left"),
                F.array_join(F.slice(F.col("_names"), i + 2, FAN), "").alias("right")))
            rows = rows.withColumn("_names", names).select("_g", "_height", "_rank", "_tops", "_path", F.explode(steps).alias("_s"))
            here = F.array(F.struct(F.col("_s.left").alias("left"), F.col("_s.right").alias("right")))
            rows = rows.select(
                "_g", "_height", "_tops", F.col("_s.kid").alias("_kid"),
                (F.col("_rank") * FAN + F.col(f"_s.kid._d{level}")).alias("_rank"),
                F.when(F.col("_height") > level, F.concat(here, F.col("_path"))).otherwise(F.col("_path")).alias("_path"),
                *([F.col("_s.kid._kids").alias("_kids")] if level else []))
        if depth:
            above = rows.select("_g", F.col("_rank").alias("_block"), "_tops", "_path")
    return rows.select("_g", "_rank", "_tops", "_path", F.col("_kid._node").alias("_node"),
                       *(F.col(f"_kid.{c}").alias(c) for c in payload))


def manifest(rows: DataFrame, group: str = "group", order: str = "id", node: str = "leaf", carry: Sequence[str] = ()) -> DataFrame:
    """``group, order, node, subroot, root, proof`` of every row, and the columns to carry along.

    ``rows`` has a row's group, its identifier within the group and its digest. A proof is an array of steps, from the
    leaf's run of siblings to the runs of the subroots: the digests before the own one in ``left``, those after it in
    ``right``, each as one text. ``fold`` leads from a leaf and its proof to the root.
    """
    payload = ["_id", *(f"_c{i}" for i in range(len(carry)))]
    own = rows.select(F.col(group).alias("_g"), F.col(node).alias("_node"), F.col(order).alias("_id"),
                      *(arrow.column(c).alias(f"_c{i}") for i, c in enumerate(carry)))
    trees = _climbed(_ranked(own, F.col("_id").asc_nulls_first(), F.col("_node")), payload)
    subroots = trees[-1].select(F.lit(0).alias("_g"), F.col("_g").alias("_name"), F.col("_node"))
    forest = _climbed(_ranked(subroots, F.col("_name").asc_nulls_first()), ["_name"])
    none = F.array().cast(f"array<{_STEP}>")
    top = forest[-1].select("_g", "_block", F.struct(F.lit("").alias("subroot"), F.col("_node").alias("root")).alias("_tops"),
                            none.alias("_path"))
    groups = _handed_down(forest, top, ["_name"])
    above = groups.select(F.col("_name").alias("_g"), F.lit(0).cast("long").alias("_block"), F.struct(
        F.col("_node").alias("subroot"), F.col("_tops.root").alias("root")).alias("_tops"), "_path")
    found = _handed_down(trees, above, payload)
    return found.select(F.col("_g").alias(group), F.col("_id").alias(order), F.col("_node").alias(node), "_tops.subroot",
                        "_tops.root", F.col("_path").alias("proof"), *(F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)))


def document_leaves(docs: DataFrame, **changed: Column) -> DataFrame:
    """``lang, doc_id, leaf`` of documents; with ``text=...`` and the like also ``claimed``, the leaf of changed values."""
    values = {name: F.col(name) for name in DOCUMENT}
    return docs.select("lang", "doc_id", leaf(list(values.values())).alias("leaf"),
                       *([leaf(list((values | changed).values())).alias("claimed")] if changed else []))
