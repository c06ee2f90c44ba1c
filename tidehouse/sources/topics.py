"""Topics. A topic is either a Kafka topic or a folder of text files with one JSON document per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidehouse import schemas
from tidehouse.functions import timefns


def kafka_options(servers: str, topic: str, starting: str | None = None, table: bool = False, **extra: str) -> dict[str, str]:
    """Options of a Kafka source. Committed offsets live in the stream's checkpoint; ``starting`` is used without one.

    By default a topic that is read as a ``table`` starts at its earliest record, any other at its latest.
    """
    starting = starting or ("earliest" if table else "latest")
    if starting not in ("latest", "earliest"):
        raise ValueError("starting must be 'latest' or 'earliest'")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **extra}


#: Column that holds a record's place in its source, and its type. Places of one source compare in the order of writing:
#: by partition and offset of a topic, by time, name and row of files. ``row`` is null where only the block is known.
POSITION = "pos"
POSITION_TYPE = "struct<source:string,row:bigint>"


def _padded(value: Column, digits: int) -> Column:
    return F.lpad(value.cast("string"), digits, "0")


def _file_position(row: Column, block: Column | None = None) -> Column:
    changed = F.unix_millis("_metadata.file_modification_time")
    parts = [_padded(changed, 15), F.col("_metadata.file_path")] + ([_padded(block, 19)] if block is not None else [])
    return F.struct(F.concat_ws(" ", *parts).alias("source"), row.cast("bigint").alias("row")).alias(POSITION)


def with_position(stored: DataFrame) -> DataFrame:
    """A stored Parquet table or stream of Parquet files with every row's place, to be used straight on the source."""
    return stored.select("*", _file_position(F.col("_metadata.row_index")))


def raw_topic(spark: SparkSession, path: str | None = None, kafka: dict[str, str] | None = None,
              stream: bool = True, position: bool = False, **options: str) -> DataFrame:
    """One ``value STRING`` row per message; empty and null messages are left out.

    With ``position`` every message carries its place beside it (``POSITION``), for rankings to order by after the event's
    own time. A stream of text files knows the file and block of a line; a table of them, and Kafka, every single record.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either path or kafka")
    reader = spark.readStream if stream else spark.read
    if kafka is not None:
        settings = {**kafka, **options}
        if not stream:
            # A batch read of a topic always covers the whole topic.
            settings["startingOffsets"] = "earliest"
        raw = _kafka_records(reader.format("kafka").options(**settings).load(), position)
    else:
        raw = reader.format("text").options(**options).load(path)
        # Numbers grow with the lines of a block, and blocks are ordered by where they start.
        row = F.lit(None) if stream else F.monotonically_increasing_id()
        raw = raw.select("value", *([_file_position(row, F.col("_metadata.file_block_start"))] if position else []))
    return raw.where(F.length("value") > 0)


def _kafka_records(records: DataFrame, position: bool) -> DataFrame:
    place = F.struct(_padded(F.col("partition"), 10).alias("source"), F.col("offset").cast("bigint").alias("row")).alias(POSITION)
    return records.select(F.col("value").cast("string").alias("value"), *([place] if position else []))


def json_table(raw: DataFrame, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """A topic as a table with a fixed schema; a malformed row fails the job when ``strict``, else gives nulls.

    Other columns, as a record's position, are carried along.
    """
    mode = "FAILFAST" if strict else "PERMISSIVE"
    rest = [name for name in raw.columns if name != "value"]
    return raw.select(F.from_json("value", schema, {"mode": mode}).alias("_r"), *rest).select("_r.*", *rest)


def change_events(raw: DataFrame, database: str | None = None, strict: bool = True) -> DataFrame:
    """Database change events, optionally of one database."""
    events = json_table(raw, schemas.CHANGE, strict)
    return events if database is None else events.where(F.col("database") == database)


def page_log(raw: DataFrame, delay: str | None = None, strict: bool = True) -> DataFrame:
    """Page views as structs plus ``row_time``, the event time in whole seconds."""
    return timefns.with_event_time(json_table(raw, schemas.PAGE, strict), delay=delay, whole_seconds=True)


def rule_changes(raw: DataFrame, rule: T.StructType, strict: bool = True) -> DataFrame:
    """Changes of a rule table as ``op``, ``before``, ``after`` and ``ts_ms``, the time of the change."""
    schema = T.StructType([*schemas.rule_change(rule).fields, T.StructField("ts_ms", T.LongType())])
    return json_table(raw, schema, strict)
