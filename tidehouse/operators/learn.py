"""Play sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidehouse import schemas
from tidehouse.functions import timefns

_SUMMED, _LATEST, _KEY = "playSec", "positionSec", "sessionId"


def _others() -> list[str]:
    return [name for name in schemas.PLAY_COLUMNS if name not in (_SUMMED, _LATEST, _KEY)]


def _from_rows(tie: Sequence[str]) -> list[Column]:
    order = F.struct("ts", *tie)
    return [
        F.sum(F.col(_SUMMED).cast("bigint")).alias("played"),
        F.max(F.struct(order.alias("at"), F.col(_LATEST).alias("position"))).alias("last"),
        F.min(F.struct(order.alias("at"), F.struct(*_others()).alias("row"))).alias("first"),
    ]


def _result(grouped: DataFrame) -> DataFrame:
    value = {_KEY: F.col(_KEY), _SUMMED: F.col("played"), _LATEST: F.col("last.position"),
             **{name: F.col(f"first.row.{name}") for name in _others()}}
    return grouped.select(*[value[name].alias(name) for name in schemas.PLAY_COLUMNS])


def play_sessions(df: DataFrame, gap: str = "3 seconds", tie: Sequence[str] = (), span: int = 40) -> DataFrame:
    """One row per play session: rows of a session id no further apart than ``gap``. Seconds played are summed, the
    position comes from the latest row, everything else from the first; ``tie`` orders rows of one instant.

    Batch: sessions are first built inside time slots of ``span`` gaps, so that a hot session id spreads over many
    tasks, and then merged over slot borders. The merge sees at most one row per gap of elapsed time, however many
    rows there were. Stream: one session window over ``row_time``, which must carry a watermark.
    """
    if df.isStreaming:
        grouped = df.groupBy(F.session_window("row_time", gap).alias("session"), _KEY).agg(*_from_rows(tie))
        return _result(grouped)

    slot_ms = timefns.duration_ms(gap) * span
    timed = df.withColumn("row_time", F.timestamp_millis("ts"))
    parts = (
        timed.groupBy(F.session_window("row_time", gap).alias("session"), _KEY,
                      F.floor(F.col("ts") / F.lit(slot_ms)).alias("slot"))
        .agg(*_from_rows(tie))
        .withColumn("start", F.col("session.start"))
        .withColumn("reach", (F.unix_micros("session.end") - F.unix_micros("session.start")))
        .drop("session", "slot")
    )
    zero = F.lit(0)
    reach = F.make_interval(zero, zero, zero, zero, zero, zero, (F.col("reach") / 1_000_000).cast("decimal(18,6)"))
    merged = parts.groupBy(F.session_window("start", reach).alias("session"), _KEY).agg(
        F.sum("played").alias("played"), F.max("last").alias("last"), F.min("first").alias("first"))
    return _result(merged)
