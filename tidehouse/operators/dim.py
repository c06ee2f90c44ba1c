"""Dimension tables: creation from rules, upsert, reading, lookup joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidehouse import sized
from tidehouse.sinks.keyed_log import AT, BATCH, KeyedLog
from tidehouse.sources import POSITION, POSITION_TYPE, tables

#: Order of writes inside a dimension log (event time, then the record's place in its source, then the write's place in the
#: log), and whether a write removes the row.
_SEQ, _DELETED = "_seq", "_deleted"
_ORDER = (_SEQ, POSITION, AT)


# ---------------------------------------------------------------- tables

def columns_of(sink_columns: str) -> list[str]:
    return [name.strip() for name in sink_columns.split(",")]


def table_schema(sink_columns: str) -> T.StructType:
    """Schema of a dimension table: every listed column as text, plus the bookkeeping of the log."""
    fields = [T.StructField(name, T.StringType()) for name in columns_of(sink_columns)]
    place = T.StructField(POSITION, T._parse_datatype_string(POSITION_TYPE))
    return T.StructType([*fields, T.StructField(_SEQ, T.LongType()), T.StructField(_DELETED, T.BooleanType()), place,
                         T.StructField(AT, T.StringType())])


def table_path(root: str, sink_table: str) -> str:
    return f"{root.rstrip('/')}/sink_table={sink_table}"


def ensure_table(spark: SparkSession, root: str, sink_table: str, sink_columns: str, sink_pk: str | None = "id",
                 sink_extend: str | None = "") -> str:
    """Create an empty dimension table unless it exists; gives its path.

    ``sink_extend`` may hold writer options as ``key=value`` pairs, separated by commas.
    """
    pk = sink_pk or "id"
    if pk not in columns_of(sink_columns):
        raise ValueError(f"key {pk!r} of {sink_table} is not among its columns")
    options = dict(pair.split("=", 1) for pair in (sink_extend or "").split(",") if "=" in pair)
    path = table_path(root, sink_table)
    log = KeyedLog(spark, path)
    if not log.state()["parts"]:
        spark.createDataFrame([], table_schema(sink_columns)).write.mode("ignore").options(**options).parquet(
            f"{path}/{BATCH}=created")
        log.commit("created", "created", None)
    return path


def _folded(rows: DataFrame, pk: str, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Per key the last removal, the last write, and for every column its last value that is not null, each with its time.

    A time is the order columns, then whether it is a write, then a hash of the write: of writes of one instant a removal
    comes first, and the columns of two writes are never mixed.
    """
    columns = [name for name in rows.columns if name not in (pk, _DELETED, *order)]
    is_write = ~F.coalesce(F.col(_DELETED), F.lit(False)) if _DELETED in rows.columns else F.lit(True)
    at = F.struct(*order, is_write.alias("_is_write"), F.xxhash64(pk, *columns).alias("_hash"))
    folded = rows.groupBy(pk).agg(
        F.max(F.when(~is_write, at)).alias("_removed"), F.max(F.when(is_write, at)).alias("_written"),
        *[F.max(F.when(is_write & F.col(name).isNotNull(), F.struct(at.alias("at"), F.col(name).alias("v")))).alias(name)
          for name in columns])
    return folded, columns


def merge_partial(rows: DataFrame, pk: str, order: Sequence[str] = (_SEQ,)) -> DataFrame:
    """Fold a log of partial rows into one row per key: for every column the latest value that is not null.

    A null means "not written". If a ``_deleted`` column exists, such a write removes the key: values from before its
    last removal do not come back, and a key without a later write is left out. Writes that are equal in all ``order``
    columns count one after the other as wholes, a removal before a write. One aggregate with map-side combine.
    """
    folded, columns = _folded(rows, pk, order)

    def after_removal(when: Column) -> Column:
        return F.col("_removed").isNull() | (when > F.col("_removed"))

    return folded.where(after_removal(F.col("_written"))).select(
        pk, *[F.when(after_removal(F.col(name)["at"]), F.col(name)["v"]).alias(name) for name in columns])


def _compacted(rows: DataFrame, pk: str) -> DataFrame:
    """A smaller log that reads the same, whatever is written to it later: per key its last removal, its last write, and
    every column's last value as a partial row of its own. Late events still fall into their place."""
    folded, columns = _folded(rows, pk, _ORDER)
    kinds = {field.name: field.dataType.simpleString() for field in rows.schema.fields}

    def entry(at: Column, is_removal: bool, column: str | None = None) -> Column:
        values = [(F.col(name)["v"] if name == column else F.lit(None).cast(kinds[name])).alias(name) for name in columns]
        return F.struct(*[at[name].cast(kinds[name]).alias(name) for name in _ORDER], F.lit(is_removal).alias(_DELETED),
                        at.isNotNull().alias("_is_there"), *values)

    entries = [entry(F.col("_removed"), True), entry(F.col("_written"), False),
               *(entry(F.col(name)["at"], False, name) for name in columns)]
    return folded.select(pk, F.inline(F.array(*entries))).where("_is_there").select(*rows.columns)


def merge_tables(old: DataFrame, new: DataFrame, pk: str) -> DataFrame:
    """Upsert one row per key into a table with one row per key; columns that ``new`` lacks or leaves null stay."""
    left, right = old.alias("o"), new.alias("n")
    merged = left.join(right, F.col(f"o.{pk}") == F.col(f"n.{pk}"), "full_outer")
    return merged.select(*[
        (F.coalesce(f"n.{name}", f"o.{name}") if name in new.columns else F.col(f"o.{name}")).alias(name)
        for name in old.columns])


def upsert_dims(routed: DataFrame, batch_id: int | None, root: str, rules: list[Mapping[str, str]],
                writer: str = "table") -> None:
    """Write one batch of routed change events (see ``cdc.route_dim``) to its dimension tables, in one job.

    Each table is an append log of partial rows; readers fold it, and ``compact_dim`` shrinks it. A batch costs its own
    rows, not the table's, and a batch of a writer that is repeated after a failure counts once. ``rules`` are the rules of
    the configuration.
    """
    spark = routed.sparkSession
    logs = {rule["sink_table"]: KeyedLog(spark, ensure_table(
        spark, root, rule["sink_table"], rule["sink_columns"], rule.get("sink_pk"), rule.get("sink_extend"))) for rule in rules}
    open_tables = [name for name, log in logs.items() if not log.is_done(writer, batch_id)]
    if not open_tables:
        return
    places = {name: logs[name].place(writer, batch_id) for name in open_tables}
    folder = places[open_tables[0]][0]
    names = sorted({name for rule in rules for name in columns_of(rule["sink_columns"])})
    deleted = F.col("deleted") if "deleted" in routed.columns else F.lit(False)
    pos = F.col(POSITION) if POSITION in routed.columns else F.lit(None).cast(POSITION_TYPE)
    at = F.create_map(*[F.lit(text) for name in open_tables for text in (name, places[name][1])])[F.col("sink_table")]
    rows = routed.where(F.col("sink_table").isin(open_tables)).select(
        *[F.col("data")[name].alias(name) for name in names], F.col("ts").try_cast("bigint").alias(_SEQ),
        deleted.alias(_DELETED), pos.alias(POSITION), at.alias(AT), "sink_table", F.lit(folder).alias(BATCH))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sink_table", BATCH).parquet(root)
    for name in open_tables:
        if logs[name].has(f"{BATCH}={folder}"):
            logs[name].commit(folder, writer, batch_id)


def read_dim(spark: SparkSession, root: str, sink_table: str, sink_columns: str, sink_pk: str | None = "id") -> DataFrame:
    """Current rows of a dimension table. Writes are ordered by event time, then by the record's position where it was
    read with one, then by the order in which batches were written."""
    log = KeyedLog(spark, table_path(root, sink_table)).read(schema=table_schema(sink_columns))
    return merge_partial(log, sink_pk or "id", _ORDER).select(*columns_of(sink_columns))


def compact_dim(spark: SparkSession, root: str, sink_table: str, sink_columns: str, sink_pk: str | None = "id") -> int:
    """Fold a dimension's batches into one level while streams go on writing; gives how many parts it replaces."""
    log = KeyedLog(spark, table_path(root, sink_table))
    return log.compact(lambda rows: _compacted(rows, sink_pk or "id"), table_schema(sink_columns))


# ---------------------------------------------------------------- lookups

def lookup_rows(dim: DataFrame, *pairs: tuple[str, object], **equals: object) -> DataFrame:
    """Dimension rows where every named column equals its value (all of them, uncached)."""
    return tables.lookup_rows(dim, *pairs, **equals)


def enrich(df: DataFrame, dim: DataFrame, on: Mapping[str, str], add: Mapping[str, str],
           limit_bytes: int = sized.BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Left outer lookup: ``on`` maps columns of ``df`` to key columns of ``dim``, ``add`` maps new columns to ``dim``
    columns. A miss gives nulls; of several dimension rows with one key the smallest is taken.

    The dimension is reduced to its needed columns and one row per key, then broadcast when small enough. A bigger one
    is joined by shuffle, where AQE splits hot keys of ``df``.
    """
    keys = [F.col(column).alias(f"_k{i}") for i, column in enumerate(on.values())]
    names = [f"_k{i}" for i in range(len(on))]
    values = F.struct(*[F.col(column).alias(name) for name, column in add.items()])
    unique = dim.select(*keys, values.alias("_v")).groupBy(*names).agg(F.min("_v").alias("_v"))
    condition = None
    for name, column in zip(names, on):
        equal = F.col(column) == F.col(name)
        condition = equal if condition is None else condition & equal
    joined = df.join(sized.small_side(sized.splittable(unique, *names), limit_bytes), condition, "left")
    return joined.select(*df.columns, *[F.col(f"_v.{name}").alias(name) for name in add])
