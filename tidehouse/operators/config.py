"""Routing rules: fold a rule table's change events and merge them with a stored copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidehouse.operators import changelog

_KEY = "source_table"


def fold_changes(changes: DataFrame, order: Sequence[str] | str) -> DataFrame:
    """Rules in force after all changes: the latest change of a source table counts, a delete removes the rule.

    ``changes`` has ``op``, ``before``, ``after`` and the ``order`` columns.
    """
    order = [order] if isinstance(order, str) else list(order)
    is_delete = F.coalesce(F.col("op") == "d", F.lit(False))
    keyed = changes.select(
        F.when(is_delete, F.col(f"before.{_KEY}")).otherwise(F.col(f"after.{_KEY}")).alias("_key"),
        is_delete.alias("_deleted"), "after", *order)
    return changelog.latest_by_key(keyed, "_key", order).where(~F.col("_deleted")).select("after.*")


def load_rules(preload: DataFrame | None = None, changes: DataFrame | None = None,
               order: Sequence[str] | str = "ts_ms") -> DataFrame:
    """Rules in force: the stored copy, overridden (or removed) by changes."""
    if changes is None:
        if preload is None:
            raise ValueError("give preload, changes or both")
        return preload
    if preload is None:
        return fold_changes(changes, order)
    order = [order] if isinstance(order, str) else list(order)
    fields = changes.schema["after"].dataType.fieldNames()
    stored = preload.select(F.lit("r").alias("op"), F.struct(*fields).alias("after"))
    return fold_changes(changes.select("op", "before", "after", *order).unionByName(stored, allowMissingColumns=True),
                        order)


#: When a rule version begins and ends to be in force; the end is null for the one in force now.
FROM, UNTIL = "_from", "_until"


def rule_versions(changes: DataFrame, order: Sequence[str] | str = "ts_ms") -> DataFrame:
    """The history of a rule table: every version of a rule with the time from which and until which it was in force.

    ``order`` begins with the time of a change; further columns, as a record's position, decide between changes of one
    instant, of which only the last is ever in force. A removal ends a version and begins none.
    """
    order = [order] if isinstance(order, str) else list(order)
    is_delete = F.coalesce(F.col("op") == "d", F.lit(False))
    keyed = changes.select(F.when(is_delete, F.col(f"before.{_KEY}")).otherwise(F.col(f"after.{_KEY}")).alias("_key"),
                           is_delete.alias("_deleted"), "after", *order)
    history = Window.partitionBy("_key").orderBy(*order)  # the changes of one rule, which is configuration
    spans = keyed.withColumn(UNTIL, F.lead(order[0]).over(history)).withColumn(FROM, F.col(order[0]))
    is_seen = F.col(UNTIL).isNull() | (F.col(UNTIL) > F.col(FROM))
    return spans.where(~F.col("_deleted") & is_seen).select("after.*", FROM, UNTIL)
