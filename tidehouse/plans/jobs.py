"""The warehouse's pipelines: source -> operators -> sink, one function per job.

Inputs are text topics (``sources.raw_topic``, a column ``value``) unless said otherwise. Outputs are folders below ``out``,
named like the topics they stand for; each job keeps its checkpoints below ``checkpoint``. Every function starts its
query (or queries) and returns them; ``trigger`` defaults to "what is there, then stop".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidehouse import schemas, sinks, sources
from tidehouse.functions import timefns
from tidehouse.operators import cdc, dim, keywords, learn, logs, parse, trade, traffic, user, window_sums

# Names of the topics between the layers.
DIRTY = "dirty_data"
LOG_TOPICS = {
    "page": "dwd_traffic_page_log",
    "start": "dwd_traffic_start_log",
    "display": "dwd_traffic_display_log",
    "action": "dwd_traffic_action_log",
    "error": "dwd_traffic_error_log",
    "video": "dwd_traffic_play_pre_process",
}
UNIQUE_VISITORS = "dwd_traffic_unique_visitor_detail"
USER_JUMPS = "dwd_traffic_user_jump_detail"
LOGINS = "dwd_user_user_login"
REGISTRATIONS = "dwd_user_user_register"
PLAYS = "dwd_learn_play"
ORDER_DETAIL = "dwd_trade_order_detail"
PAY_SUCCESS = "dwd_trade_pay_suc_detail"
TRAFFIC_SUMS = "dws_traffic_vc_source_ar_is_new_page_view_window"
KEYWORD_COUNTS = "dws_traffic_source_keyword_page_view_window"


def _timed(df: DataFrame, delay: str) -> DataFrame:
    return timefns.with_event_time(df, delay=delay)


def _lines(df: DataFrame, out: str, checkpoint: str, topic: str, trigger: dict | None) -> StreamingQuery:
    rows = df.drop("row_time") if "row_time" in df.columns else df
    return sinks.append(rows, f"{out}/{topic}", f"{checkpoint}/{topic}", "json", trigger)


# ---------------------------------------------------------------- log layer

def split_site_log(raw: DataFrame, out: str, checkpoint: str, tz: str = timefns.DEFAULT_TZ,
                   trigger: dict | None = None) -> StreamingQuery:
    """Site log -> six detail topics and the dirty rows, in one query that reads and parses the log once; visitor flags are
    repaired on the way."""
    tagged = logs.split_tagged(logs.repair_is_new(parse.with_dirty(raw, record=parse.RECORD), tz))
    names = LOG_TOPICS | {parse.DIRTY: DIRTY}
    topic = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])[F.col("output")]
    return sinks.fan_out(tagged.withColumn("output", topic), out, f"{checkpoint}/site_log", trigger)


def unique_visitors(pages: DataFrame, out: str, checkpoint: str, tz: str = timefns.DEFAULT_TZ,
                    delay: str = "15 seconds", trigger: dict | None = None) -> StreamingQuery:
    visitors = traffic.unique_visitors(_timed(parse.strict(pages, typed=schemas.PAGE), delay), tz)
    return _lines(visitors, out, checkpoint, UNIQUE_VISITORS, trigger)


def user_jumps(pages: DataFrame, out: str, checkpoint: str, limit: str = "10 seconds", delay: str = "0 seconds",
               trigger: dict | None = None) -> StreamingQuery:
    jumps = traffic.user_jumps(_timed(parse.drop_bad(pages, typed=schemas.PAGE), delay), limit)
    return _lines(jumps, out, checkpoint, USER_JUMPS, trigger)


def first_logins(pages: DataFrame, out: str, checkpoint: str, tz: str = timefns.DEFAULT_TZ, delay: str = "5 seconds",
                 trigger: dict | None = None) -> StreamingQuery:
    opened = user.first_login(_timed(parse.drop_bad(pages, typed=schemas.PAGE), delay))
    return _lines(logs.flatten_login(opened, tz), out, checkpoint, LOGINS, trigger)


def play_sessions(videos: DataFrame, out: str, checkpoint: str, gap: str = "3 seconds", delay: str = "5 seconds",
                  trigger: dict | None = None) -> StreamingQuery:
    plays = _timed(logs.flatten_play(parse.drop_bad(videos)), delay)
    return _lines(learn.play_sessions(plays, gap), out, checkpoint, PLAYS, trigger)


# ---------------------------------------------------------------- business layer

def _events(raw: DataFrame) -> DataFrame:
    return parse.drop_bad(raw, schemas.CHANGE, schemas.CHANGE)


def route_changes(raw: DataFrame, load_rules: Callable[[], DataFrame], out: str, checkpoint: str, mode: str = "exact",
                  trigger: dict | None = None) -> StreamingQuery:
    """Change events -> the detail topics that the rules name. Rules are read anew for every batch."""
    return sinks.routed(cdc.drop_control(_events(raw)), out, f"{checkpoint}/routed", trigger,
                        lambda batch: cdc.route_detail(batch, load_rules(), mode))


def sink_dims(raw: DataFrame, load_rules: Callable[[], DataFrame], out: str, checkpoint: str,
              apply_deletes: bool = False, trigger: dict | None = None) -> StreamingQuery:
    """Change events -> dimension tables. Rules are read anew for every batch; their tables are made on first sight."""
    def write(batch: DataFrame, writer: str, number: int | None) -> None:
        rules = load_rules()
        # The rule table is small configuration, one row per source table; it names the columns to write.
        listed = [row.asDict() for row in rules.collect()]
        dim.upsert_dims(cdc.route_dim(batch, rules, apply_deletes), number, out, listed, writer)

    return sinks.for_each_batch(cdc.drop_control(_events(raw), keep_snapshot_rows=True), write, f"{checkpoint}/dims",
                                trigger)


#: Milliseconds of a unit of a change event's ``ts``. Logs always count milliseconds.
TS_UNITS = {"ms": 1, "s": 1000}


def _with_change_time(df: DataFrame, delay: str, ts_unit: str) -> DataFrame:
    if ts_unit not in TS_UNITS:
        raise ValueError(f"ts_unit must be one of {tuple(TS_UNITS)}, not {ts_unit!r}")
    in_ms = df.withColumn("_ms", F.col("ts").try_cast("bigint") * TS_UNITS[ts_unit])
    return timefns.with_event_time(in_ms, "_ms", delay=delay)


def _change_time(raw: DataFrame, delay: str, ts_unit: str, strict: bool) -> DataFrame:
    return _with_change_time(parse.strict(raw, schemas.CHANGE, schemas.CHANGE) if strict else _events(raw), delay, ts_unit)


def _page_table(pages: DataFrame, delay: str, strict: bool) -> DataFrame:
    return _timed((parse.strict if strict else parse.drop_bad)(pages, typed=schemas.PAGE), delay)


def _carried(df: DataFrame) -> list[str]:
    """Event time, and the position where the topic was read with one."""
    return ["row_time", *[name for name in (sources.POSITION,) if name in df.columns]]


def read_table(spark: SparkSession, out: str, topic: str) -> DataFrame:
    """The keyed table behind one of the upsert logs of this layer."""
    key = "user_id" if topic == REGISTRATIONS else "id"
    return sinks.read_upserted(spark, f"{out}/{topic}", key, trade.ORDER).drop(trade.ORDER)


def order_detail(changes: DataFrame, pages: DataFrame, out: str, checkpoint: str, within: str = "10 seconds",
                 delay: str = "10 seconds", trigger: dict | None = None, ts_unit: str = "ms",
                 strict: bool = True) -> StreamingQuery:
    """Order lines joined with orders and order pages, as an upsert log by line id.

    ``ts_unit`` is the unit in which change events count ``ts``. A malformed record fails the job, or is dropped without
    ``strict``; so in the other jobs over tables.
    """
    events = _change_time(changes, delay, ts_unit, strict)
    page_log = _page_table(pages, delay, strict)
    wide = trade.order_detail(trade.detail_slice(events, *_carried(events)), trade.order_slice(events, *_carried(events)),
                              trade.order_pages(page_log, *_carried(page_log)), within, op_time=True)
    return sinks.upsert(wide, f"{out}/{ORDER_DETAIL}", "id", trade.ORDER, f"{checkpoint}/{ORDER_DETAIL}", trigger)


def pay_success(changes: DataFrame, details: DataFrame, out: str, checkpoint: str, within: str = "905 seconds",
                delay: str = "10 seconds", trigger: dict | None = None, ts_unit: str = "ms",
                strict: bool = True) -> StreamingQuery:
    """Paid order lines, as an upsert log by line id. ``details`` is a stream over the order-line log."""
    events = _change_time(changes, delay, ts_unit, strict)
    lines = _with_change_time(details, delay, ts_unit).drop("_ms")
    paid = trade.pay_success(trade.payment_slice(events, *_carried(events)), lines, within, op_time=True)
    return sinks.upsert(paid, f"{out}/{PAY_SUCCESS}", "id", trade.ORDER, f"{checkpoint}/{PAY_SUCCESS}", trigger)


def register(changes: DataFrame, pages: DataFrame, out: str, checkpoint: str, within: str = "10 seconds",
             delay: str = "10 seconds", page_id: str | None = None, trigger: dict | None = None, ts_unit: str = "ms",
             strict: bool = True) -> StreamingQuery:
    """Registrations with device data, as an upsert log by user."""
    events = _change_time(changes, delay, ts_unit, strict)
    page_log = _page_table(pages, delay, strict)
    rows = user.register(user.user_slice(events, *_carried(events)), user.login_dims(page_log, page_id, *_carried(page_log)),
                         within, op_time=True)
    return sinks.upsert(rows, f"{out}/{REGISTRATIONS}", "user_id", trade.ORDER, f"{checkpoint}/{REGISTRATIONS}", trigger)


# ---------------------------------------------------------------- summary layer

#: A dimension as it is, or a function that reads it (as ``lambda: dim.read_dim(...)``).
Dimension = DataFrame | Callable[[], DataFrame]


def _now(dimension: Dimension) -> DataFrame:
    return dimension() if callable(dimension) else dimension


def traffic_sums(pages: DataFrame, visitors: DataFrame, jumps: DataFrame, source_names: Dimension, province_names: Dimension,
                 out: str, checkpoint: str, width: str = "10 seconds", delay: str = "15 seconds",
                 tz: str = timefns.DEFAULT_TZ, trigger: dict | None = None, one_watermark: bool = True) -> StreamingQuery:
    """Windowed traffic sums with names. ``pages`` fails on text that cannot be parsed, as do the two detail topics.

    A dimension given as a function is read anew for every batch, so that a row written to it names the sums of the next
    batch; one given as a DataFrame stays as the stream found it.
    """
    records = [parse.strict(topic, typed=schemas.PAGE) for topic in (pages, visitors, jumps)]
    sums = window_sums.traffic_window(*records, width, delay, tz, one_watermark=one_watermark)
    return sinks.ordered_append(sums, f"{out}/{TRAFFIC_SUMS}", schemas.TRAFFIC_COLUMNS, (), f"{checkpoint}/{TRAFFIC_SUMS}",
                                trigger, each=lambda batch: window_sums.with_names(batch, _now(source_names), _now(province_names)))


def keyword_counts(pages: DataFrame, out: str, checkpoint: str, width: str = "10 seconds", delay: str = "5 seconds",
                   tz: str = timefns.DEFAULT_TZ, dictionary: DataFrame | None = None,
                   trigger: dict | None = None) -> StreamingQuery:
    """Windowed keyword counts of search texts."""
    terms = logs.search_terms(sources.page_log(pages, delay))
    counts = keywords.keyword_window(keywords.explode_tokens(terms, dictionary=dictionary), width, tz=tz)
    return sinks.ordered_append(counts, f"{out}/{KEYWORD_COUNTS}", schemas.KEYWORD_COLUMNS, (),
                                f"{checkpoint}/{KEYWORD_COUNTS}", trigger)
