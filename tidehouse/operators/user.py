"""User details: first logins and registrations."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidehouse import schemas, session
from tidehouse.functions import timefns
from tidehouse.operators import changelog, logs
from tidehouse.operators.within import last_within, with_match
from tidehouse.sources import POSITION

#: Later than any time.
_NEVER = 2 ** 62


# ---------------------------------------------------------------- first login

def _start(at: Column, width: int) -> Column:
    """Where the time slot begins that ``at`` is in."""
    return at - F.pmod(at, F.lit(width))


def _following(times: DataFrame, hold_ms: int, slot_ms: int) -> DataFrame:
    """Every distinct time ``(_key, _ts)`` with ``_next``, the first time of its key at least ``hold_ms`` later, and whether
    it is the first of its slot.

    A threshold lies in exactly one slot, so slots are looked at one by one, however many rows a key has: thresholds and
    times of a slot stand in one order, beside the first time of any later slot for thresholds beyond its last time.
    """
    slot = Window.partitionBy("_key", "_slot")
    times = times.select("_key", _start(F.col("_ts"), slot_ms).alias("_slot"), "_ts").distinct()
    times = times.withColumn("_first", F.min("_ts").over(slot))
    firsts = times.where("_ts = _first").select("_key", "_slot", "_first")
    asks = firsts.select("_key", (F.col("_slot") + hold_ms).alias("_slot"), F.lit(None).cast("bigint").alias("_first"))
    down = Window.partitionBy("_key").orderBy(F.col("_slot").desc(), F.col("_first").asc_nulls_first())  # one row per slot
    later = firsts.unionByName(asks).withColumn("_later", F.last("_first", True).over(
        down.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where(F.col("_first").isNull())

    none = F.lit(None).cast("bigint")
    shown = [
        times.select("_key", "_slot", F.col("_ts").alias("_at"), F.col("_ts").alias("_found"), none.alias("_ts"), none.alias("_first")),
        later.select("_key", "_slot", F.lit(_NEVER).alias("_at"), F.col("_later").alias("_found"), none.alias("_ts"), none.alias("_first")),
        times.select("_key", (F.col("_slot") + hold_ms).alias("_slot"), (F.col("_ts") + hold_ms).alias("_at"), none.alias("_found"),
                     "_ts", "_first"),
    ]
    backwards = slot.orderBy(F.col("_at").desc(), F.col("_ts").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    answered = shown[0].unionByName(shown[1]).unionByName(shown[2]).withColumn("_next", F.last("_found", True).over(backwards))
    return answered.where(F.col("_ts").isNotNull()).select("_key", "_ts", "_next", (F.col("_ts") == F.col("_first")).alias("_is_first"))


def login_times(logins: DataFrame, key: Column, hold: str = "1 day", slots_per_hold: int = 24) -> DataFrame:
    """Opening times ``(_key, _ts)`` of the login episodes of every key: the first row opens one, and so does the first
    row at least ``hold`` after the last opening.

    Every opening depends on the one before it, but a period of ``hold`` has one opening at most. So each period has a
    transition table: for each time that may open there, where the chain goes next. Tables of two neighbouring spans are
    composed into one for twice the span by a join on key and time, until one span holds everything; only times that the
    chain can enter a span by are kept, which halves the rows each round. Then the first time of every key is followed back
    down, one span size after the other. Joins meet unique (key, time) pairs and windows hold one slot of one key, so a
    device with any share of all rows is spread; rounds grow with the logarithm of the time covered.

    Tables of the rounds are written to the shared folder while this is called. ``slots_per_hold`` cuts a period into
    slots that are looked at apart.
    """
    hold_ms = timefns.duration_ms(hold)
    slot_ms = hold_ms // math.gcd(hold_ms, slots_per_hold)
    rows = logins.select(key.alias("_key"), F.col("ts").cast("bigint").alias("_ts")).where("_key is not null and _ts is not null")
    path = session.shared_dir(logins.sparkSession, "logins")

    def written(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{path}/{name}")
        return logins.sparkSession.read.schema(table.schema).parquet(f"{path}/{name}")

    tables = [written(_following(rows, hold_ms, slot_ms), "0")]
    least, most = tables[0].agg(F.min("_ts"), F.max("_ts")).first()
    if least is None:
        return tables[0].select("_key", "_ts")
    base, width = least - least % hold_ms, hold_ms

    def span(at: Column) -> Column:
        return _start(at - base, width)

    while base + width <= most:
        width *= 2
        inside = F.col("_next").isNotNull() & (span(F.col("_ts")) == span(F.col("_next")))
        entries = tables[-1].where(F.col("_is_first") | (F.pmod(F.col("_ts") - base, F.lit(width)) < hold_ms))
        onward = tables[-1].select(F.col("_key").alias("_k"), F.col("_ts").alias("_t"), F.col("_next").alias("_after"))
        met = entries.join(onward, inside & (F.col("_key") == F.col("_k")) & (F.col("_next") == F.col("_t")), "left")
        after = F.when(inside, F.col("_after")).otherwise(F.col("_next"))
        tables.append(written(met.select("_key", "_ts", after.alias("_next"), "_is_first"), str(len(tables))))

    opened = tables[-1].groupBy("_key").agg(F.min("_ts").alias("_ts"))
    for table in reversed(tables[:-1]):
        inside = F.col("_next").isNotNull() & (span(F.col("_ts")) == span(F.col("_next")))
        steps = table.where(inside).select(F.col("_key").alias("_k"), F.col("_ts").alias("_t"), "_next")
        both = F.when(F.col("_next").isNull(), F.array("_ts")).otherwise(F.array("_ts", "_next"))
        opened = opened.join(steps, (F.col("_key") == F.col("_k")) & (F.col("_ts") == F.col("_t")), "left").select(
            "_key", F.explode(both).alias("_ts"))
        width //= 2
    return opened


def first_login(df: DataFrame, key: str = "common.mid", hold: str = "1 day", wait: str = "10 seconds",
                tie: Sequence[str] = (), slots_per_hold: int = 24) -> DataFrame:
    """First page view with a user id per device, and again after ``hold`` without an opening.

    ``wait`` is how long a stream keeps an episode open for rows that arrive late but happened earlier; in batch all
    rows are present. ``tie`` orders rows of one instant. Output rows are whole log records.
    """
    logins = logs.page_slice(df, logged_in=True)
    if df.isStreaming:
        from tidehouse.streaming import stateful
        return stateful.first_login(logins, key, hold, wait, tie)
    logins = logins.where(F.col(key).isNotNull())
    times = login_times(logins, F.col(key), hold, slots_per_hold)
    opened = logins.join(times, (F.col(key) == F.col("_key")) & (F.col("ts") == F.col("_ts")))
    return _one_per_instant(opened, tie)


def _one_per_instant(opened: DataFrame, tie: Sequence[str]) -> DataFrame:
    same = Window.partitionBy("_key", "_ts").orderBy("_ts", *tie)
    return opened.withColumn("_rank", F.row_number().over(same)).where(F.col("_rank") == 1).drop("_rank", "_key", "_ts")


# ---------------------------------------------------------------- registration

def user_slice(events: DataFrame, *carry: str) -> DataFrame:
    """New users of a change stream."""
    from tidehouse.operators import cdc
    rows = cdc.slice_table(events, "user_info", {"id": "id", "create_time": "create_time"}, op="insert", carry=carry)
    return rows.withColumn("create_date", timefns.date_of_text("create_time"))


def login_dims(pages: DataFrame, page_id: str | None = None, *carry: str) -> DataFrame:
    """What a logged-in page view says about its user; ``page_id`` narrows to one page (default: any)."""
    source = {"user_id": "uid", "channel": "ch", "province_id": "ar", "version_code": "vc", "source_id": "sc",
              "mid_id": "mid", "brand": "ba", "model": "md", "operate_system": "os"}
    return logs.page_slice(pages, page_id, logged_in=True).select(
        *[F.col("common")[field].alias(name) for name, field in source.items()], F.col("ts").alias("log_ts"), *carry)


def register(users: DataFrame, dims: DataFrame, within: str | None = None, op_time: bool = False) -> DataFrame:
    """Registrations with the device data of the user's page views; one row per user, the latest ones count.

    Without ``within`` both sides are first reduced to their latest row per user, so that the join meets unique keys
    however many page views a user has. With ``within`` (always on a stream; both sides then need ``row_time``) only
    page views within that time of the registration count; a stream gives every pair with its ``trade.ORDER``, and the
    upsert log by that column stands for the table that batch gives.
    """
    from tidehouse.operators import trade
    streaming = users.isStreaming or dims.isStreaming
    if within is None:
        if streaming:
            raise ValueError("a stream needs 'within'")
        place = [POSITION] if POSITION in users.columns else []
        users = changelog.latest_by_key(users.withColumn("_at", F.col("ts").try_cast("bigint")), "id",
                                        ["_at", *place, "create_time"]).drop("_at", POSITION)
        dims = changelog.latest_by_key(dims, "user_id", _dims_order(dims))
        joined = users.join(dims, users["id"] == dims["user_id"], "left")
    else:
        span = timefns.interval(within)
        users = users.withColumnRenamed(POSITION, "_user_pos")
        order = ["_at", "_user_pos", "create_time", *_dims_order(dims)]
        dims = dims.withColumnRenamed("row_time", "log_time")
        if streaming:
            near = F.col("log_time").between(F.col("row_time") - span, F.col("row_time") + span)
            joined = users.join(dims, (F.col("id") == F.col("user_id")) & near, "left")
        else:
            found = last_within(users, dims, ("id", "user_id"), ("row_time", "log_time"), timefns.duration_ms(within) * 1000,
                                _dims_order(dims)[1:])
            joined = with_match(found, dims.columns)
        joined = trade.in_order(joined.withColumn("_at", F.col("ts").try_cast("bigint")), *order)
        if not streaming:
            joined = changelog.latest_by_key(joined, "id", trade.ORDER)
    value = {"user_id": F.col("id"), "register_time": F.col("create_time"), "register_date": F.col("create_date")}
    names = [*schemas.REGISTER_COLUMNS, *([trade.ORDER] if streaming else [])]
    out = joined.select(*[value.get(name, F.col(name)).alias(name) for name in names])
    return out.withColumn("row_op_ts", F.current_timestamp()) if op_time else out


def _dims_order(dims: DataFrame) -> list[str]:
    place = [POSITION] if POSITION in dims.columns else []
    return ["log_ts", *place] + [name for name in dims.columns if name not in ("log_ts", "user_id", "row_time", "log_time", POSITION)]
