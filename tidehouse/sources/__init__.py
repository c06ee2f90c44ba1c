"""Sources: text topics, JSON tables on topics, stored tables."""

from tidehouse.sources.tables import lookup_rows, table  # noqa: F401
from tidehouse.sources.topics import (  # noqa: F401
    POSITION,
    POSITION_TYPE,
    change_events,
    json_table,
    kafka_options,
    page_log,
    raw_topic,
    rule_changes,
    with_position,
)
