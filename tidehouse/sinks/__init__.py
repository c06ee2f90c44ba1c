"""Sinks for batches and streams."""

from tidehouse.sinks.files import (  # noqa: F401
    append,
    batch_name,
    compact_upserted,
    fan_out,
    for_each_batch,
    kafka_message,
    kafka_sink_options,
    ordered_append,
    read_upserted,
    routed,
    routed_text,
    to_json_value,
    to_kafka,
    upsert,
)
from tidehouse.sinks.keyed_log import KeyedLog, writer_of  # noqa: F401
