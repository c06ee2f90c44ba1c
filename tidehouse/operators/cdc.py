"""Database change events: control events, slices of one table, routing by rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidehouse.functions import mapfns
from tidehouse import sized
from tidehouse.operators import config

# Types of the change events that mark a table snapshot.
SNAPSHOT_START, SNAPSHOT_END, SNAPSHOT_ROW = "bootstrap-start", "bootstrap-complete", "bootstrap-insert"

PAID = "1602"


def drop_control(events: DataFrame, keep_snapshot_rows: bool = False) -> DataFrame:
    """Leave out snapshot events and events without a type. The dimension path keeps the rows of a snapshot."""
    dropped = [SNAPSHOT_START, SNAPSHOT_END] + ([] if keep_snapshot_rows else [SNAPSHOT_ROW])
    return events.where(~F.col("type").isin(dropped))


def slice_table(events: DataFrame, table: str, columns: Mapping[str, str], op: str | None = None,
                where: Column | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Rows of one source table as columns: ``columns`` maps an output name to a key of ``data``.

    ``op`` narrows to one operation, ``where`` to any condition on the event. ``ts`` and ``carry`` are kept.
    """
    rows = events.where(F.col("table") == table)
    if op is not None:
        rows = rows.where(F.col("type") == op)
    if where is not None:
        rows = rows.where(where)
    return rows.select(*[F.col("data")[key].alias(name) for name, key in columns.items()], "ts", *carry)


def whitelist(events: DataFrame, names: str | Column, mode: str = "exact") -> DataFrame:
    """Keep the listed columns of ``data``; ``names`` is the comma list (text, or a column that holds it)."""
    names = F.lit(names) if isinstance(names, str) else names
    return events.withColumn("data", mapfns.whitelist("data", names, mode))


def route_detail(events: DataFrame, rules: DataFrame, mode: str = "exact") -> DataFrame:
    """Events that a detail rule names by table and operation, as ``(sink_table, ts, data)``.

    Rules are a small table: they are broadcast when their size is below the limit, and events are not shuffled then.
    """
    rule = sized.small_side(rules.select(
        F.col("source_table").alias("_table"), F.col("source_type").alias("_type"), "sink_table",
        F.col("sink_columns").alias("_columns")), probe_rows=sized.RULE_ROWS)
    matched = events.join(rule, (F.col("table") == F.col("_table")) & (F.col("type") == F.col("_type")))
    return whitelist(matched, F.col("_columns"), mode).select("sink_table", "ts", "data")


def route_detail_as_of(events: DataFrame, versions: DataFrame, mode: str = "exact") -> DataFrame:
    """Events by the detail rule that was in force at their own time, as ``(sink_table, ts, data)``.

    ``versions`` are ``config.rule_versions``, whose times are in the unit of the events' ``ts``; a change counts for events of
    its own instant. So a replay gives what it gave at the time, whatever the rules are now. A small history is broadcast; a
    bigger one meets the events by table and operation, where AQE splits a busy table.
    """
    rule = sized.small_side(versions.select(
        F.col("source_table").alias("_table"), F.col("source_type").alias("_type"), "sink_table",
        F.col("sink_columns").alias("_columns"), config.FROM, config.UNTIL), probe_rows=sized.RULE_ROWS)
    at = F.col("ts").try_cast("bigint")
    is_in_force = (at >= F.col(config.FROM)) & (F.col(config.UNTIL).isNull() | (at < F.col(config.UNTIL)))
    matched = events.join(rule, (F.col("table") == F.col("_table")) & (F.col("type") == F.col("_type")) & is_in_force)
    return whitelist(matched, F.col("_columns"), mode).select("sink_table", "ts", "data")


def route_dim(events: DataFrame, rules: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """Events that a dimension rule names by table, as ``(sink_table, sink_pk, type, ts, data)``; a position goes along.

    Any operation passes, so a deleted row is written like any other; with ``apply_deletes`` the operation is kept in
    ``deleted`` for the sink to act upon.
    """
    rule = sized.small_side(rules.select(
        F.col("source_table").alias("_table"), "sink_table",
        F.coalesce("sink_pk", F.lit("id")).alias("sink_pk"), F.col("sink_columns").alias("_columns")),
        probe_rows=sized.RULE_ROWS)
    matched = events.where(F.col("type").isNotNull()).join(rule, F.col("table") == F.col("_table"))
    deleted = (F.col("type") == "delete") if apply_deletes else F.lit(False)
    place = [name for name in ("pos",) if name in events.columns]
    return whitelist(matched, F.col("_columns")).select(
        "sink_table", "sink_pk", "type", "ts", deleted.alias("deleted"), "data", *place)
