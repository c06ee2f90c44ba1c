"""Trade details: order lines and paid order lines as wide rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidehouse import schemas, sized
from tidehouse.functions import timefns
from tidehouse.operators import cdc, changelog, logs
from tidehouse.operators.within import last_within, with_match
from tidehouse.sources import POSITION

# ---------------------------------------------------------------- slices


def detail_slice(events: DataFrame, *carry: str) -> DataFrame:
    """New order lines."""
    keys = ("id", "order_id", "user_id", "course_id", "create_time", "origin_amount", "coupon_reduce", "final_amount")
    rows = cdc.slice_table(events, "order_detail", {key: key for key in keys}, op="insert", carry=carry)
    return rows.withColumn("date_id", timefns.date_of_text("create_time"))


def order_slice(events: DataFrame, *carry: str) -> DataFrame:
    """New orders."""
    keys = ("id", "province_id", "out_trade_no", "session_id", "trade_body")
    return cdc.slice_table(events, "order_info", {key: key for key in keys}, op="insert", carry=carry) \
        .withColumnRenamed("ts", "order_ts")


def payment_slice(events: DataFrame, *carry: str) -> DataFrame:
    """Successful payments, whatever the operation."""
    keys = ("alipay_trade_no", "trade_body", "order_id", "payment_type", "payment_status", "callback_time",
            "callback_content")
    return cdc.slice_table(events, "payment_info", {key: key for key in keys},
                           where=F.col("data")["payment_status"] == cdc.PAID, carry=carry)


def order_pages(pages: DataFrame, *carry: str) -> DataFrame:
    """Source of the sessions that reached the order page."""
    return logs.page_slice(pages, "order").select(
        F.col("common")["sid"].alias("page_session"), F.col("common")["sc"].alias("source_id"),
        F.col("ts").alias("page_ts"), *carry)


# ---------------------------------------------------------------- joins

def _stamp(out: DataFrame, op_time: bool) -> DataFrame:
    return out.withColumn("row_op_ts", F.current_timestamp()) if op_time else out


def _pick(joined: DataFrame, names: tuple[str, ...], renamed: dict[str, str]) -> DataFrame:
    return joined.select(*[F.col(renamed.get(name, name)).alias(name) for name in names])


#: Column with what decides between several rows of one key, in order: times, positions where the inputs have them, values.
#: An upsert log keeps it, so that a stream's table ends up with the row that batch picks.
ORDER = "_order"


def in_order(joined: DataFrame, *columns: str) -> DataFrame:
    """Add the order column; positions that no input has are left out."""
    return joined.withColumn(ORDER, F.struct(*[name for name in columns if name in joined.columns]))


def _places(df: DataFrame, name: str) -> list[str]:
    """The position column, where there is one."""
    return [name] if name in df.columns else []


def order_detail(details: DataFrame, orders: DataFrame, pages: DataFrame, within: str | None = None,
                 op_time: bool = False) -> DataFrame:
    """Order lines with their order (inner) and the source of the session (left outer), one row per input line.

    Batch without ``within``: orders and order pages are reduced to the latest row of their key and joined first, so
    that the lines, the biggest input, are shuffled once and meet unique keys. An order with very many lines is skew on
    that side, which AQE splits. Stream, or batch with ``within``: the parts must be that close in event time
    (``row_time`` on all three inputs; a stream needs watermarks on them). Batch gives the last match of every line; a stream
    gives every match with its ``ORDER``, and the upsert log by that column stands for the same table. Batch looks for the
    last match alone (``within.last_within``), so a session or order with very many rows on both sides makes no pairs.
    """
    streaming = details.isStreaming or orders.isStreaming or pages.isStreaming
    renamed = {"coupon_reduce_amount": "coupon_reduce"}
    if within is None:
        if streaming:
            raise ValueError("a stream needs 'within'")
        pages = changelog.latest_by_key(pages, "page_session", ["page_ts", *_places(pages, POSITION), "source_id"]).drop(POSITION)
        orders = orders.withColumn("_order_at", F.col("order_ts").try_cast("bigint"))
        orders = changelog.latest_by_key(orders, "id", ["_order_at", *_places(orders, POSITION), "out_trade_no"])
        orders = orders.withColumnRenamed("id", "_oid").drop(POSITION)
        sourced = orders.join(sized.splittable(pages, "page_session"), F.col("session_id") == F.col("page_session"), "left")
        joined = details.join(sized.splittable(sourced, "_oid"), F.col("order_id") == F.col("_oid"))
        return _stamp(_pick(joined, schemas.ORDER_DETAIL_COLUMNS, renamed), op_time)

    span = timefns.interval(within)
    details = details.withColumnRenamed(POSITION, "_detail_pos")
    orders = orders.withColumnsRenamed({"id": "_oid", "row_time": "_order_time", POSITION: "_order_pos"}).withColumn(
        "_order_at", F.col("order_ts").try_cast("bigint"))
    pages = pages.withColumnsRenamed({"row_time": "_page_time", POSITION: "_page_pos"})
    if streaming:
        near_order = F.col("_order_time").between(F.col("row_time") - span, F.col("row_time") + span)
        # Only one event-time column may go on to the second join.
        first = details.join(orders, (F.col("order_id") == F.col("_oid")) & near_order).drop("_order_time")
        near_page = F.col("_page_time").between(F.col("row_time") - span, F.col("row_time") + span)
        joined = first.join(pages, (F.col("session_id") == F.col("page_session")) & near_page, "left")
    else:
        bound = timefns.duration_ms(within) * 1000
        found = last_within(details, orders, ("order_id", "_oid"), ("row_time", "_order_time"), bound,
                            [*_places(orders, "_order_pos"), "out_trade_no"])
        first = with_match(found, orders.columns, inner=True)
        found = last_within(first, pages, ("session_id", "page_session"), ("row_time", "_page_time"), bound,
                            [*_places(pages, "_page_pos"), "source_id"])
        joined = with_match(found, pages.columns)
    joined = in_order(joined.withColumn("_at", F.col("ts").try_cast("bigint")), "_at", "_detail_pos", "_order_at", "_order_pos",
                      "out_trade_no", "page_ts", "_page_pos", "source_id")
    if streaming:
        return _stamp(_pick(joined, (*schemas.ORDER_DETAIL_COLUMNS, ORDER), renamed), op_time)
    return _stamp(_pick(changelog.latest_by_key(joined, "id", ORDER), schemas.ORDER_DETAIL_COLUMNS, renamed), op_time)


def pay_success(payments: DataFrame, details: DataFrame, within: str | None = None, op_time: bool = False) -> DataFrame:
    """Order lines of paid orders, one row per line; the latest payment of an order counts.

    ``details`` is the result of ``order_detail`` (an upsert log may hold a line several times: reduce it with
    ``changelog.latest_by_key`` first). ``within`` as in ``order_detail``.
    """
    streaming = payments.isStreaming or details.isStreaming
    renamed = {"original_amount": "origin_amount"}
    payments = payments.withColumnsRenamed({"order_id": "_paid_order", POSITION: "_paid_pos"})
    details = details.drop("trade_body", "ts", "row_op_ts", POSITION).withColumnRenamed(ORDER, "_detail_order")
    order = ["_at", *_places(payments, "_paid_pos"), "callback_time", "alipay_trade_no"]
    if within is None:
        if streaming:
            raise ValueError("a stream needs 'within'")
        payments = changelog.latest_by_key(payments.withColumn("_at", F.col("ts").try_cast("bigint")), "_paid_order",
                                           order)
        joined = details.join(sized.splittable(payments, "_paid_order"), F.col("order_id") == F.col("_paid_order"))
    else:
        details = details.withColumnRenamed("row_time", "_detail_time")
        if streaming:
            span = timefns.interval(within)
            near = F.col("_detail_time").between(F.col("row_time") - span, F.col("row_time") + span)
            joined = payments.join(details, (F.col("order_id") == F.col("_paid_order")) & near)
        else:
            found = last_within(details, payments, ("order_id", "_paid_order"), ("_detail_time", "row_time"),
                                timefns.duration_ms(within) * 1000, order[1:])
            joined = with_match(found, payments.columns, inner=True)
        joined = in_order(joined.withColumn("_at", F.col("ts").try_cast("bigint")), *order, "_detail_order")
        if streaming:
            return _stamp(_pick(joined, (*schemas.PAY_SUCCESS_COLUMNS, ORDER), renamed), op_time)
        joined = changelog.latest_by_key(joined, "id", ORDER)
    return _stamp(_pick(joined, schemas.PAY_SUCCESS_COLUMNS, renamed), op_time)
