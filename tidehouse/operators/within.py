"""The last matching row within a bound of time, without forming all pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def last_within(left: DataFrame, right: DataFrame, on: tuple[str, str], times: tuple[str, str], within_us: int,
                order: Sequence[str] = ()) -> DataFrame:
    """Every left row with ``_match``, the last right row of its key whose time is at most ``within_us`` microseconds before or
    after its own, by time and then the ``order`` columns; null where there is none.

    ``on`` and ``times`` name the key and the timestamp of both sides. Time is cut into buckets as wide as the bound reaches.
    In a bucket of a key, left and right rows stand in one order of time, behind the last right row of the bucket before:
    the last right row before the end of a left row's bound is its match, if it is not too old. Work grows with the rows of
    both sides; a key with very many rows on both is spread over its buckets.
    """
    width = max(2 * within_us, 1)
    here = F.unix_micros(F.col(times[1]))
    rows = right.where(F.col(on[1]).isNotNull() & F.col(times[1]).isNotNull()).select(
        F.col(on[1]).alias("_key"), here.alias("_at"), F.struct(here.alias("_time"), *order, F.struct(*right.columns).alias("_row")).alias("_v"))
    rows = rows.withColumn("_bucket", F.col("_at") - F.pmod("_at", F.lit(width)))
    last = rows.groupBy("_key", "_bucket").agg(F.max("_v").alias("_v"))
    end = F.unix_micros(F.col(times[0])) + within_us
    asks = left.select(F.col(on[0]).alias("_key"), end.alias("_at"), F.struct(*left.columns).alias("_left"))
    asks = asks.withColumn("_bucket", F.col("_at") - F.pmod("_at", F.lit(width)))
    shown = [
        last.select("_key", (F.col("_bucket") + width).alias("_bucket"), (F.col("_bucket") + width - 1).alias("_at"), "_v"),
        rows.select("_key", "_bucket", "_at", "_v"),
        asks.select("_key", "_bucket", "_at", "_left"),
    ]
    both = shown[0].unionByName(shown[1]).unionByName(shown[2], allowMissingColumns=True)
    ranks = [f"_v.{name}" for name in order]
    in_order = Window.partitionBy("_key", "_bucket").orderBy("_at", F.col("_left").isNotNull(), *ranks).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn("_last", F.last("_v", True).over(in_order)).where(F.col("_left").isNotNull())
    match = F.when(F.col("_last._time") >= F.col("_at") - 2 * within_us, F.col("_last._row"))
    return met.select("_left.*", match.alias("_match"))


def with_match(found: DataFrame, columns: Sequence[str], inner: bool = False) -> DataFrame:
    """Left columns, and the match's columns beside them; ``inner`` leaves out rows without a match."""
    rows = found.where(F.col("_match").isNotNull()) if inner else found
    return rows.select(*[name for name in found.columns if name != "_match"], *[F.col("_match")[name].alias(name) for name in columns])
