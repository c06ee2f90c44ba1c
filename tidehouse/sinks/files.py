"""Sinks. File sinks are exactly-once: a stream's own file log, or a folder per batch that a retry replaces.

The Kafka sink of Spark is at-least-once; ``kafka_message`` therefore gives messages a key that is the same on a retry.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidehouse.operators import changelog
from tidehouse.sinks import keyed_log

BATCH = keyed_log.BATCH


def to_json_value(df: DataFrame, *carry: str) -> DataFrame:
    """Rows as JSON text in ``value`` (nulls are left out); ``carry`` columns stay beside it and out of the text."""
    return df.select(*carry, F.to_json(F.struct(*[name for name in df.columns if name not in carry])).alias("value"))


def kafka_sink_options(servers: str, topic: str | None = None, **extra: str) -> dict[str, str]:
    """Options of a Kafka sink; without a topic every row names its own in column ``topic``."""
    return {"kafka.bootstrap.servers": servers, **({"topic": topic} if topic else {}), **extra}


def kafka_message(df: DataFrame, key: Sequence[str] = (), topic: str | None = None) -> DataFrame:
    """Rows as ``(key, value[, topic])``: the key is JSON text of the key columns, or a digest of the whole row."""
    fields = [name for name in df.columns if name != topic]
    text = F.to_json(F.struct(*fields))
    message_key = F.to_json(F.struct(*key)) if key else F.sha2(text, 256)
    head = [F.col(topic).alias("topic")] if topic else []
    return df.select(*head, message_key.alias("key"), text.alias("value"))


def _start(writer, trigger: dict | None) -> StreamingQuery:
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def append(df: DataFrame, path: str, checkpoint: str | None = None, fmt: str = "json", trigger: dict | None = None,
           partition_by: Sequence[str] = ()) -> StreamingQuery | None:
    """Append rows to a folder. ``trigger`` defaults to "what is there, then stop"."""
    writer = df.writeStream if df.isStreaming else df.write
    writer = writer.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not df.isStreaming:
        writer.mode("append").save(path)
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    return _start(writer.outputMode("append").option("path", path).option("checkpointLocation", checkpoint), trigger)


def to_kafka(df: DataFrame, servers: str, topic: str | None = None, checkpoint: str | None = None,
             trigger: dict | None = None, **extra: str) -> StreamingQuery | None:
    """Write messages (see ``kafka_message``) to a topic, or each to the topic in its column ``topic``."""
    settings = kafka_sink_options(servers, topic, **extra)
    if not df.isStreaming:
        df.write.format("kafka").options(**settings).save()
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    return _start(df.writeStream.format("kafka").options(**settings).option("checkpointLocation", checkpoint), trigger)


def routed_text(df: DataFrame) -> DataFrame:
    """Rows of ``cdc.route_detail`` as ``(sink_table, value)``: the target's name is not part of the text, ``ts`` is."""
    record = F.map_concat(F.map_filter("data", lambda key, _: key != "ts"), F.create_map(F.lit("ts"), F.col("ts")))
    return df.select("sink_table", F.to_json(record).alias("value"))


def routed(df: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None,
           route: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery | None:
    """Rows of ``cdc.route_detail`` as JSON text, each in the folder its ``sink_table`` names.

    With ``route``, ``df`` holds events and ``route`` is applied to every batch anew, so that rules may change while
    the stream runs. A batch that is retried replaces its own folders.
    """
    def write(batch: DataFrame, writer: str, number: int | None) -> None:
        rows = routed_text(route(batch) if route else batch).withColumn(BATCH, F.lit(batch_name(writer, number)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("sink_table", BATCH).text(path)

    return for_each_batch(df, write, checkpoint, trigger)


def fan_out(tagged: DataFrame, path: str, checkpoint: str | None = None,
            trigger: dict | None = None) -> StreamingQuery | None:
    """Rows ``(output, value)`` to one folder per output, in one pass over the input."""
    return append(tagged.select("output", "value"), path, checkpoint, "text", trigger, ["output"])


def for_each_batch(df: DataFrame, write, checkpoint: str | None, trigger: dict | None) -> StreamingQuery | None:
    """Call ``write(rows, writer, number)`` once for a table, or for every batch of a stream.

    A stream's writer is named after its checkpoint and its batch keeps its number on a retry; a call with a table is a
    writer of its own, without a number.
    """
    if not df.isStreaming:
        write(df, uuid.uuid4().hex[:12], None)
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = keyed_log.writer_of(checkpoint)
    return _start(df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: write(batch, writer, number)), trigger)


def batch_name(writer: str, number: int | None) -> str:
    return f"{writer}-{0 if number is None else number:09d}"


def upsert(df: DataFrame, path: str, key: Sequence[str] | str, order: Sequence[str] | str,
           checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery | None:
    """Upsert by key: every batch adds its latest row per key to a log; ``read_upserted`` gives the table.

    A batch costs its own rows, whatever the size of the table, and a batch that is retried counts once.
    ``compact_upserted`` shrinks the log while streams go on writing to it.
    """
    def write(batch: DataFrame, writer: str, number: int | None) -> None:
        keyed_log.KeyedLog(batch.sparkSession, path).append(changelog.latest_by_key(batch, key, order), writer, number)

    return for_each_batch(df, write, checkpoint, trigger)


def read_upserted(spark: SparkSession, path: str, key: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """The table an upsert log stands for; of equally new rows the one written later counts."""
    order = [order] if isinstance(order, str) else list(order)
    return changelog.latest_by_key(keyed_log.KeyedLog(spark, path).read(), key, [*order, keyed_log.AT]).drop(keyed_log.AT)


def compact_upserted(spark: SparkSession, path: str, key: Sequence[str] | str, order: Sequence[str] | str) -> int:
    """Fold an upsert log's batches into one level with one row per key; gives how many batches and levels it replaces."""
    order = [order] if isinstance(order, str) else list(order)
    return keyed_log.KeyedLog(spark, path).compact(lambda rows: changelog.latest_by_key(rows, key, [*order, keyed_log.AT]))


def ordered_append(df: DataFrame, path: str, columns: Sequence[str], transient: Sequence[str] = (),
                   checkpoint: str | None = None, trigger: dict | None = None,
                   jdbc: dict[str, str] | None = None,
                   each: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery | None:
    """Append declared columns in declared order, transient ones left out. ``each`` is applied to every batch anew, so
    that what it reads, as a dimension, is as of that batch.

    To parquet at ``path``, or over JDBC with ``path`` as table name and ``jdbc`` as options (``batchsize`` sets rows per
    round trip; the trigger sets the interval).
    """
    chosen: list[str | Column] = [name for name in columns if name not in transient]

    def write(batch: DataFrame, writer: str, number: int | None) -> None:
        rows = (each(batch) if each else batch).select(*chosen)
        if jdbc is not None:
            rows.write.format("jdbc").options(dbtable=path, **jdbc).mode("append").save()
        else:
            rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_name(writer, number)}")

    return for_each_batch(df, write, checkpoint, trigger)
