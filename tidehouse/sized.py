"""Join sides: broadcast only after a size check, and keep skewed shuffle joins splittable."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

#: Largest side that is broadcast, by the optimizer's size estimate.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

#: Largest rule table that is broadcast when its size is unknown; a rule is a few short texts.
RULE_ROWS = 10_000


def estimated_bytes(df: DataFrame) -> int:
    """Size of a DataFrame as the optimizer estimates it from file sizes and table statistics."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES, probe_rows: int = 0) -> DataFrame:
    """Mark a join side for broadcast when it is small enough.

    A side of unknown size (a JDBC table, rows from the driver) has an estimate beyond any limit. With ``probe_rows`` it is
    broadcast after all if it has no more rows than that; the probe reads one row more at most. Anything bigger is returned
    as it is: Spark then shuffles both sides by the join key and AQE splits skewed keys.
    """
    if df.isStreaming:
        return df
    if estimated_bytes(df) <= limit_bytes or (probe_rows and df.limit(probe_rows + 1).count() <= probe_rows):
        return F.broadcast(df)
    return df


def splittable(df: DataFrame, *keys: str) -> DataFrame:
    """Let a join on ``keys`` shuffle this side anew, although it is already distributed by them.

    AQE splits a hot key of a join only where both inputs come straight from a shuffle. The result of an aggregate or a
    ranking by the join key would be joined in place, and a hot key on the other side would then stay in one task. Here
    the keys are written as expressions the planner does not see through. Meant for reduced sides with unique keys: their
    second shuffle is small against what the split saves.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}
    rewritten = {
        key: F.concat(key, F.lit("")) if isinstance(kinds[key], T.StringType) else F.when(F.col(key).isNotNull(), F.col(key))
        for key in keys}
    return df.withColumns(rewritten)
