"""Time: epoch milliseconds, local dates, watermarks, window bounds.

Every function takes one explicit time zone. Results do not depend on the zone of the session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_TZ = "Asia/Shanghai"

DATE_PATTERN = "yyyy-MM-dd"
DATETIME_PATTERN = "yyyy-MM-dd HH:mm:ss"

DAY_MS = 86_400_000

_UNITS_MS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": DAY_MS, "week": 7 * DAY_MS}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def duration_ms(text: str) -> int:
    """Length of a duration such as ``"10 seconds"`` or ``"1 day"`` in milliseconds."""
    words = text.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {text!r}")
    total = 0
    for number, unit in zip(words[::2], words[1::2]):
        unit = unit.lower().rstrip("s")
        if unit not in _UNITS_MS:
            raise ValueError(f"not a duration: {text!r}")
        total += int(number) * _UNITS_MS[unit]
    return total


def interval(text: str) -> Column:
    """The same duration as an interval literal."""
    return F.expr(f"INTERVAL '{duration_ms(text) / 1000:.3f}' SECOND")


def local_time(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Wall-clock time in ``tz`` of an epoch-millisecond column."""
    return F.convert_timezone(None, F.lit(tz), F.timestamp_millis(_col(ms)))


def local_day(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Calendar day in ``tz``, as a date (cheaper to compare and shuffle than text)."""
    return local_time(ms, tz).cast("date")


def to_date_text(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd``."""
    return F.date_format(local_time(ms, tz), DATE_PATTERN)


def to_datetime_text(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(local_time(ms, tz), DATETIME_PATTERN)


def to_millis(text: Column | str, full: bool = False, tz: str = DEFAULT_TZ) -> Column:
    """Date text (or date-time text when ``full``) in ``tz`` to epoch milliseconds."""
    pattern = DATETIME_PATTERN if full else DATE_PATTERN
    local = F.to_timestamp_ntz(_col(text), F.lit(pattern))
    return F.unix_millis(F.convert_timezone(F.lit(tz), F.current_timezone(), local).cast("timestamp"))


def date_of_text(text: Column | str) -> Column:
    """Day part of a date-time text, as text; null for text that is no date-time."""
    return F.date_format(F.try_to_timestamp(_col(text)), DATE_PATTERN)


def row_time(ms: Column | str) -> Column:
    """Event time of an epoch-millisecond column, cut to whole seconds."""
    return F.timestamp_seconds(F.floor(_col(ms) / F.lit(1000)))


def emit_time_ms() -> Column:
    """Time of emission in epoch milliseconds (one value per micro-batch)."""
    return F.unix_millis(F.current_timestamp())


def with_event_time(df: DataFrame, ms: str = "ts", name: str = "row_time", delay: str | None = None,
                    whole_seconds: bool = False) -> DataFrame:
    """Add an event-time column; on a stream also the watermark (``delay=None`` means no watermark)."""
    value = row_time(ms) if whole_seconds else F.timestamp_millis(F.col(ms))
    out = df.withColumn(name, value)
    return out.withWatermark(name, delay) if delay is not None and df.isStreaming else out


def window_bounds(window: str = "window", tz: str = DEFAULT_TZ) -> list[Column]:
    """Start and end of a window column as text columns ``stt`` and ``edt``."""
    return [
        to_datetime_text(F.unix_millis(F.col(f"{window}.start")), tz).alias("stt"),
        to_datetime_text(F.unix_millis(F.col(f"{window}.end")), tz).alias("edt"),
    ]
