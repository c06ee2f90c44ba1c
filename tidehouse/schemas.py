"""Schemas of the records that travel between the layers."""

from __future__ import annotations

from pyspark.sql import types as T


_TEXT, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_TEXTS = T.ArrayType(_TEXT)
_TEXT_MAP = T.MapType(_TEXT, _TEXT)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _texts(*names: str) -> T.StructType:
    return _struct(**{name: _TEXT for name in names})


COMMON_FIELDS = ("mid", "is_new", "uid", "sid", "ar", "ba", "ch", "md", "os", "sc", "vc")

#: What the JSON text is parsed with: scalars stay text, so a number sent as text does not make a record dirty.
WIRE_LOG = _struct(
    common=_texts(*COMMON_FIELDS),
    page=_texts("page_id", "last_page_id", "during_time", "item", "item_type"),
    start=_TEXT,
    err=_TEXT,
    appVideo=_texts("play_sec", "video_id", "position_sec"),
    displays=_TEXTS,
    actions=_TEXTS,
    ts=_TEXT,
)

#: The typed site log. ``start``, ``err`` and the array elements stay JSON text: they are only passed through.
LOG = _struct(
    common=_texts(*COMMON_FIELDS),
    page=_struct(page_id=_TEXT, last_page_id=_TEXT, during_time=_LONG, item=_TEXT, item_type=_TEXT),
    start=_TEXT,
    err=_TEXT,
    appVideo=_struct(play_sec=_INT, video_id=_TEXT, position_sec=_INT),
    displays=_TEXTS,
    actions=_TEXTS,
    ts=_LONG,
)

#: One page view, after the log was split.
PAGE = T.StructType([LOG["common"], LOG["page"], LOG["ts"]])

#: Page log as a table of maps.
PAGE_MAPS = _struct(common=_TEXT_MAP, page=_TEXT_MAP, ts=_LONG)

#: Database change event.
CHANGE = T.StructType([
    *_texts("database", "table", "type").fields, T.StructField("data", _TEXT_MAP), T.StructField("ts", _TEXT)])

DETAIL_RULE = _texts("source_table", "source_type", "sink_table", "sink_columns")
DIM_RULE = _texts("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")


def rule_change(rule: T.StructType) -> T.StructType:
    """Change event of a rule table: operation, row before, row after."""
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("before", rule),
        T.StructField("after", rule),
    ])


PLAY_COLUMNS = (
    "sourceId", "provinceId", "userId", "operatingSystem", "channel", "isNew", "model", "machineId", "versionCode",
    "brand", "sessionId", "playSec", "positionSec", "videoId", "ts",
)

LOGIN_COLUMNS = (
    "userId", "dateId", "loginTime", "sourceId", "channel", "provinceId", "versionCode", "midId", "brand", "model",
    "operatingSystem", "ts",
)

TRAFFIC_COLUMNS = (
    "stt", "edt", "versionCode", "sourceId", "sourceName", "ar", "provinceName", "isNew", "uvCount",
    "totalSessionCount", "pageViewCount", "totalDuringTime", "jumpSessionCount", "ts",
)

KEYWORD_COLUMNS = ("stt", "edt", "source", "keyword", "keyword_count", "ts")

ORDER_DETAIL_COLUMNS = (
    "id", "order_id", "user_id", "course_id", "province_id", "date_id", "session_id", "source_id", "create_time",
    "origin_amount", "coupon_reduce_amount", "final_amount", "out_trade_no", "trade_body", "ts",
)

PAY_SUCCESS_COLUMNS = (
    "id", "order_id", "user_id", "course_id", "province_id", "date_id", "alipay_trade_no", "trade_body",
    "payment_type", "payment_status", "callback_time", "callback_content", "original_amount",
    "coupon_reduce_amount", "final_amount", "ts",
)

REGISTER_COLUMNS = (
    "user_id", "register_time", "register_date", "channel", "province_id", "version_code", "source_id", "mid_id",
    "brand", "model", "operate_system", "ts",
)

CELL = T.StructType([
    *_texts("row", "family", "qualifier", "value").fields, T.StructField("ts", _LONG), T.StructField("type", _TEXT)])
