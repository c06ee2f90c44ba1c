"""Windowed traffic sums by source, version, area and visitor flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidehouse.functions import timefns
from tidehouse.operators import dim

KEYS = ("sourceId", "versionCode", "ar", "isNew")
COUNTERS = ("uvCount", "totalSessionCount", "pageViewCount", "totalDuringTime", "jumpSessionCount")


def to_metrics(df: DataFrame, **counters: Column) -> DataFrame:
    """One metric row per record: four keys, the counters given (others 0) and ``ts``."""
    zero = F.lit(0)
    return df.select(
        F.col("common.sc").alias("sourceId"), F.col("common.vc").alias("versionCode"), F.col("common.ar").alias("ar"),
        F.col("common.is_new").alias("isNew"),
        *[counters.get(name, zero).cast("bigint").alias(name) for name in COUNTERS], "ts")


def page_metrics(pages: DataFrame) -> DataFrame:
    return to_metrics(
        pages, pageViewCount=F.lit(1), totalDuringTime=F.coalesce("page.during_time", F.lit(0)),
        totalSessionCount=F.when(F.col("page.last_page_id").isNull(), 1).otherwise(0))


def visitor_metrics(visitors: DataFrame) -> DataFrame:
    return to_metrics(visitors, uvCount=F.lit(1))


def jump_metrics(jumps: DataFrame) -> DataFrame:
    return to_metrics(jumps, jumpSessionCount=F.lit(1))


def traffic_window(pages: DataFrame, visitors: DataFrame, jumps: DataFrame, width: str = "10 seconds",
                   delay: str = "15 seconds", tz: str = timefns.DEFAULT_TZ, emit_time: bool = True,
                   one_watermark: bool = True) -> DataFrame:
    """Five sums per tumbling window and key. Rows of the three inputs are added up in one aggregate, which Spark
    combines on the map side: a hot key sends one row per window and map task.

    On streams one watermark stands over the union of the three, so a quiet input holds nothing back; ``delay`` is to cover
    how much later visitors and bounces come than the pages they are made from. Without ``one_watermark`` each input has its
    own and the slowest one counts: nothing of a slow input is late, but an input without any rows holds all windows back."""
    inputs = [page_metrics(pages), visitor_metrics(visitors), jump_metrics(jumps)]
    if not one_watermark:
        inputs = [timefns.with_event_time(rows, delay=delay) for rows in inputs]
    timed = inputs[0].unionByName(inputs[1]).unionByName(inputs[2])
    if one_watermark:
        timed = timefns.with_event_time(timed, delay=delay)
    summed = timed.groupBy(F.window("row_time", width).alias("window"), *KEYS).agg(
        *[F.sum(name).alias(name) for name in COUNTERS])
    emit = [timefns.emit_time_ms().alias("ts")] if emit_time else []
    return summed.select(*timefns.window_bounds("window", tz), "versionCode", "sourceId", "ar", "isNew", *COUNTERS, *emit)


def with_names(sums: DataFrame, sources: DataFrame, provinces: DataFrame, source_key: str = "ID",
               source_name: str = "SOURCE_SITE", province_key: str = "ID", province_name: str = "NAME") -> DataFrame:
    """Add source and province names, after the aggregate so that only sums meet the dimensions."""
    named = dim.enrich(sums, sources, {"sourceId": source_key}, {"sourceName": source_name})
    named = dim.enrich(named, provinces, {"ar": province_key}, {"provinceName": province_name})
    head = ["stt", "edt", "versionCode", "sourceId", "sourceName", "ar", "provinceName", "isNew"]
    return named.select(*head, *[name for name in named.columns if name not in head])
