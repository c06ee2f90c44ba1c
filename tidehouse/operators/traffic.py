"""Traffic details: unique visitors and bounces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidehouse.functions import timefns
from tidehouse.operators import logs


def unique_visitors(df: DataFrame, tz: str = timefns.DEFAULT_TZ, tie: Sequence[str] = ()) -> DataFrame:
    """First session start of every device on every day; ``tie`` orders rows of one instant.

    Batch: ranking with a limit of one, which Spark applies on the map side too, so a hot device sends at most one row
    per day and map task. Stream: state per device, dropped a day after the last visit; needs ``row_time`` with a
    watermark.
    """
    starts = logs.session_starts(df)
    if df.isStreaming:
        from tidehouse.streaming import stateful
        return stateful.unique_visitors(starts, tz, tie)
    per_day = Window.partitionBy("common.mid", timefns.local_day("ts", tz)).orderBy("ts", *tie)
    return starts.withColumn("_rank", F.row_number().over(per_day)).where(F.col("_rank") == 1).drop("_rank")


def user_jumps(df: DataFrame, limit: str = "10 seconds", tie: Sequence[str] = (), span: int = 8) -> DataFrame:
    """Bounces: session starts that no other page of the device follows within ``limit``, or that are directly
    followed by another session start.

    Only the next ``limit`` of time matters to a row. Each device's timeline is therefore cut into slots of ``span``
    times the limit, and the first ``limit`` of a slot is shown to the slot before it as well. Slots are independent:
    the work of a hot device spreads over as many tasks as it has slots, with one shuffle and 1/span more rows.
    A gap of exactly ``limit`` is a bounce.
    """
    if df.isStreaming:
        from tidehouse.streaming import stateful
        return stateful.user_jumps(df, limit, tie)
    limit_ms = timefns.duration_ms(limit)
    slot = F.floor(F.col("ts") / F.lit(limit_ms * span))
    is_near_slot_start = F.pmod(F.col("ts"), F.lit(limit_ms * span)) < limit_ms

    def place(at, own):
        return F.struct(at.alias("slot"), F.lit(own).alias("own"))

    places = F.when(is_near_slot_start, F.array(place(slot, True), place(slot - 1, False))) \
        .otherwise(F.array(place(slot, True)))
    placed = df.withColumn("_place", F.explode(places))
    follow = Window.partitionBy("common.mid", "_place.slot").orderBy("ts", *tie)
    is_start = F.col("page.last_page_id").isNull()
    seen = placed.withColumn("_next", F.lead(F.struct("ts", is_start.alias("start"))).over(follow))
    bounced = F.col("_next").isNull() | (F.col("_next.ts") - F.col("ts") >= limit_ms) | F.col("_next.start")
    return seen.where(F.col("_place.own") & is_start & bounced).drop("_place", "_next")
