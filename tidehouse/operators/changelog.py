"""Keyed tables kept as append logs: the row that counts is the latest one of its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def latest_by_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """The latest row of every key by the ``order`` columns.

    A ranking limited to one row: Spark applies the limit before the shuffle as well, so a hot key sends one row per
    map task.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    newest_first = Window.partitionBy(*key).orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return df.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") == 1).drop("_rank")


def compact(spark: SparkSession, source: str, target: str, key: Sequence[str] | str,
            order: Sequence[str] | str) -> DataFrame:
    """Write the latest rows of an upsert log to a new folder and return that table, as ``sinks.read_upserted`` gives it.

    The target is a table, not a log: a stream goes on writing to ``source``. ``sinks.compact_upserted`` folds a log in place.
    """
    from tidehouse import sinks
    sinks.read_upserted(spark, source, key, order).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
