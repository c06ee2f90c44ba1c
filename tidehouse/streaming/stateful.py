"""Keyed state for the operators whose rule depends on what a key did before.

Rows reach a processor in Arrow batches with a few plain columns; the record itself travels as one JSON text that Python
does not look into. Rows of one micro-batch are taken in order of time, and ``pos`` where given. Event-time timers both
close what is pending and drop state that is no longer needed.

All of these need the RocksDB state store (``session.RECOMMENDED``). Those with timers need ``row_time`` with a watermark.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidehouse.functions import timefns

EVENT_TIME = "row_time"
#: Groups that rows without a device are dealt to.
LANES = 4096
DAY_MS = timefns.DAY_MS

# Workers get the processors with the job, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---------------------------------------------------------------- packing

def _pack(df: DataFrame, key: Column, *extra: Column) -> DataFrame:
    body = F.to_json(F.struct(*[name for name in df.columns if name != EVENT_TIME]))
    time = [EVENT_TIME] if EVENT_TIME in df.columns else []
    return df.select(key.alias("k"), F.col("ts").alias("t"), *extra, body.alias("body"), *time)


def _unpack(out: DataFrame, df: DataFrame, *extra: str) -> DataFrame:
    """Records again; ``row_time`` is recomputed and carries no watermark."""
    schema = df.drop(EVENT_TIME).schema
    rows = out.select(F.from_json("body", schema).alias("r"), *extra).select("r.*", *extra)
    return rows.withColumn(EVENT_TIME, F.timestamp_millis("ts")) if EVENT_TIME in df.columns else rows


def _pos(tie: Sequence[str]) -> Column:
    if len(tie) > 1:
        raise ValueError("a stream takes one position column at most")
    return (F.col(tie[0]).cast("bigint") if tie else F.lit(0).cast("bigint")).alias("pos")


def _need_event_time(df: DataFrame) -> None:
    if EVENT_TIME not in df.columns:
        raise ValueError(f"the stream needs {EVENT_TIME} with a watermark (functions.timefns.with_event_time)")


def _bodies(values) -> pd.DataFrame:
    return pd.DataFrame({"body": list(values)}, dtype="object")


# ---------------------------------------------------------------- new/old visitor flag

class IsNewRepair(StatefulProcessor):
    """State: the day the device's first visit counts for. Set once, kept for good."""

    def init(self, handle) -> None:
        self.first = handle.getValueState("first_day", "day INT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            # Records without a device, and dirty rows, belong to no device; as in batch they stay as they are. They come
            # in many groups, none of which keeps state.
            for pdf in rows:
                yield pd.DataFrame({"body": pdf["body"], "stale": False})
            return
        if not self.first.exists():
            # The first batch of a device must be seen whole to know its first record.
            rows = list(rows)
            earliest = min((pdf.sort_values(["t", "old"], kind="stable").iloc[0] for pdf in rows),
                           key=lambda row: (row["t"], row["old"]))
            self.first.update((int(earliest["day"]) - int(earliest["old"]),))
        first_day = self.first.get()[0]
        for pdf in rows:
            stale = (pdf["old"] == 0) & (pdf["day"] != first_day)
            yield pd.DataFrame({"body": pdf["body"], "stale": stale})

    def close(self) -> None:
        pass


def repair_is_new(df: DataFrame, tz: str) -> DataFrame:
    day = F.unix_date(timefns.local_day("ts", tz)).alias("day")
    old = F.when(F.col("common.is_new") == "1", 0).otherwise(1).alias("old")
    packed = _pack(df, F.col("common.mid"), day, old)
    lane = F.when(F.col("k").isNull(), F.pmod(F.xxhash64("body"), F.lit(LANES))).otherwise(-1).alias("lane")
    out = packed.select("*", lane).groupBy("k", "lane").transformWithStateInPandas(
        IsNewRepair(), "body STRING, stale BOOLEAN", "Append", "None")
    rows = _unpack(out, df, "stale")
    is_new = F.when(F.col("stale"), "0").otherwise(F.col("common.is_new"))
    return rows.withColumn("common", F.col("common").withField("is_new", is_new)).drop("stale")


# ---------------------------------------------------------------- unique visitors

class UniqueVisitors(StatefulProcessor):
    """State: last day a visit was accepted for, dropped one day after that visit."""

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_day", "day INT, expires LONG")

    def handleInputRows(self, key, rows, timerValues):
        firsts = None
        for pdf in rows:
            both = pdf if firsts is None else pd.concat([firsts, pdf])
            firsts = both.sort_values(["day", "t", "pos"], kind="stable").drop_duplicates("day")
        state = self.last.get() if self.last.exists() else None
        accepted = firsts if state is None else firsts[firsts["day"] > state[0]]
        if len(accepted):
            newest = accepted.iloc[-1]
            if state is not None:
                self.handle.deleteTimer(state[1])
            expires = int(newest["t"]) + DAY_MS
            self.last.update((int(newest["day"]), expires))
            self.handle.registerTimer(expires)
            yield _bodies(accepted["body"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.last.exists() and self.last.get()[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        yield _bodies([])

    def close(self) -> None:
        pass


def unique_visitors(starts: DataFrame, tz: str, tie: Sequence[str] = ()) -> DataFrame:
    _need_event_time(starts)
    day = F.unix_date(timefns.local_day("ts", tz)).alias("day")
    out = _pack(starts, F.col("common.mid"), day, _pos(tie)).groupBy("k").transformWithStateInPandas(
        UniqueVisitors(), "body STRING", "Append", "EventTime")
    return _unpack(out, starts)


# ---------------------------------------------------------------- first login

class FirstLogin(StatefulProcessor):
    """State: the earliest row of the open episode, when it closes to late rows, and whether it was given out."""

    def __init__(self, hold_ms: int, wait_ms: int) -> None:
        self.hold_ms, self.wait_ms = hold_ms, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.episode = handle.getValueState("episode", "t LONG, body STRING, due LONG, given BOOLEAN")

    def _open(self, t: int, body: str):
        self.handle.registerTimer(t + self.wait_ms)
        self.handle.registerTimer(t + self.hold_ms)
        return (t, body, t + self.wait_ms, False)

    def _drop_timers(self, episode) -> None:
        for at in (episode[2], episode[0] + self.hold_ms):
            self.handle.deleteTimer(at)

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat([pdf[["t", "pos", "body"]] for pdf in rows]).sort_values(["t", "pos"], kind="stable")
        times, bodies = batch["t"].to_numpy(), batch["body"].to_numpy()
        episode = self.episode.get() if self.episode.exists() else None
        out, at = [], 0
        while at < len(times):
            t, body = int(times[at]), bodies[at]
            if episode is None:
                episode = self._open(t, body)
            elif t < episode[0] and not episode[3]:
                self.handle.deleteTimer(episode[0] + self.hold_ms)
                self.handle.registerTimer(t + self.hold_ms)
                episode = (t, body, episode[2], False)
            elif t >= episode[0] + self.hold_ms:
                if not episode[3]:
                    out.append(episode[1])
                self._drop_timers(episode)
                episode = self._open(t, body)
            # Everything up to the end of the episode changes nothing any more.
            at = max(at + 1, int(times.searchsorted(episode[0] + self.hold_ms)))
        self.episode.update(episode)
        yield _bodies(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, out = expiredTimerInfo.getExpiryTimeInMs(), []
        if self.episode.exists():
            episode = self.episode.get()
            if now >= episode[2] and not episode[3]:
                out.append(episode[1])
                episode = (episode[0], None, episode[2], True)
                self.episode.update(episode)
            if now >= episode[0] + self.hold_ms:
                self.episode.clear()
        yield _bodies(out)

    def close(self) -> None:
        pass


def first_login(logins: DataFrame, key: str, hold: str, wait: str, tie: Sequence[str] = ()) -> DataFrame:
    _need_event_time(logins)
    processor = FirstLogin(timefns.duration_ms(hold), timefns.duration_ms(wait))
    packed = _pack(logins.where(F.col(key).isNotNull()), F.col(key), _pos(tie))
    out = packed.groupBy("k").transformWithStateInPandas(processor, "body STRING", "Append", "EventTime")
    return _unpack(out, logins)


# ---------------------------------------------------------------- bounces

#: Groups that devices are dealt to; a stream's checkpoint holds to it.
JUMP_LANES = 512
#: Rows of a lane that are written, or read and sorted, at once.
JUMP_ROWS = 100_000
#: A row that waits for what follows it.
_OPEN = pa.schema([("mid", pa.string()), ("t", pa.int64()), ("pos", pa.int64()), ("start", pa.bool_()), ("body", pa.string())])


class UserJumps(StatefulProcessor):
    """State: rows whose next ``limit`` of time has not passed yet, as Arrow tables for every slot of ``limit``; the text
    is kept for session starts only. A row can depend on its own slot and the next one alone, so a timer reads what is
    due and one slot more, sorts it, and lays each row beside the one after it.

    A group is a lane of many devices, so that calls, timers and state entries grow with lanes and slots rather than with
    devices. What a call or a timer holds is bounded by ``JUMP_ROWS`` and the rows of two slots.
    """

    def __init__(self, limit_ms: int) -> None:
        self.limit_ms = limit_ms

    def init(self, handle) -> None:
        self.handle = handle
        # Of every open slot: its number, its earliest time, and the numbers of its tables from the first to before the end.
        self.index = handle.getValueState("index", "slots BINARY")
        self.tables = handle.getMapState("tables", "slot LONG, part LONG", "rows BINARY")

    def _slots(self) -> dict[int, list[int]]:
        if not self.index.exists():
            return {}
        return {slot: rest for slot, *rest in np.frombuffer(self.index.get()[0], np.int64).reshape(-1, 4).tolist()}

    def _keep(self, slots: dict[int, list[int]]) -> None:
        if slots:
            self.index.update((np.array([(slot, *rest) for slot, rest in sorted(slots.items())], np.int64).tobytes(),))
        else:
            self.index.clear()

    def _read(self, slots: dict[int, list[int]], slot: int) -> list[pa.Table]:
        _, begin, end = slots[slot]
        return [pa.ipc.open_stream(self.tables.getValue((slot, part))[0]).read_all() for part in range(begin, end)]

    def _write(self, slots: dict[int, list[int]], slot: int, rows: pa.Table, earliest: int) -> None:
        known = slots.setdefault(slot, [earliest, 0, 0])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _OPEN) as out:
            out.write_table(rows)
        self.tables.updateValue((slot, known[2]), (sink.getvalue().to_pybytes(),))
        known[0], known[2] = min(known[0], earliest), known[2] + 1

    def _remove(self, slots: dict[int, list[int]], slot: int) -> None:
        _, begin, end = slots.pop(slot)
        for part in range(begin, end):
            self.tables.removeKey((slot, part))

    def _add(self, slots: dict[int, list[int]], held: list[pd.DataFrame]) -> None:
        rows = pd.concat(held, ignore_index=True)
        rows = rows.iloc[np.argsort((rows["t"] // self.limit_ms).to_numpy(), kind="stable")]
        table = pa.Table.from_pandas(rows, _OPEN, preserve_index=False)
        times = rows["t"].to_numpy()
        slot = times // self.limit_ms
        starts = np.flatnonzero(np.insert(slot[1:] != slot[:-1], 0, True))
        for begin, end in zip(starts, [*starts[1:], len(slot)], strict=True):
            self._write(slots, int(slot[begin]), table.slice(begin, end - begin), int(times[begin:end].min()))

    def handleInputRows(self, key, rows, timerValues):
        slots = self._slots()
        first = min((rest[0] for rest in slots.values()), default=None)
        held, n = [], 0
        for pdf in rows:
            held.append(pdf[_OPEN.names])
            n += len(pdf)
            if n >= JUMP_ROWS:
                self._add(slots, held)
                held, n = [], 0
        if held:
            self._add(slots, held)
        self._keep(slots)
        now = min(rest[0] for rest in slots.values())
        if first is None or now < first:  # there is one timer for the earliest row at all times
            self.handle.registerTimer(now + self.limit_ms)
        yield _bodies([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # A timer expires when the watermark is beyond it: rows before ``due`` are settled.
        due = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1) - self.limit_ms
        slots = self._slots()
        closing = sorted(slot for slot, rest in slots.items() if rest[0] < due)
        at = 0
        while at < len(closing):
            begin, tables, n = at, [], 0
            while at < len(closing) and (at == begin or n < JUMP_ROWS):
                tables += (own := self._read(slots, closing[at]))
                n += sum(table.num_rows for table in own)
                at += 1
            last = closing[at - 1]
            if last + 1 in slots:
                tables += self._read(slots, last + 1)
            rows = pa.concat_tables(tables).to_pandas()
            rows["device"] = pd.factorize(rows["mid"])[0]  # rows without a device are one device
            rows = rows.sort_values(["device", "t", "pos"], kind="stable")
            device, times, start = (rows[name].to_numpy() for name in ("device", "t", "start"))
            alone = np.ones(len(rows), bool)
            alone[:-1] = (device[1:] != device[:-1]) | (np.diff(times) >= self.limit_ms) | start[1:]
            yield _bodies(rows["body"][start & alone & (times < min(due, (last + 1) * self.limit_ms))])
            rest = rows[(times >= due) & (times // self.limit_ms == last)]
            for slot in closing[begin:at]:
                self._remove(slots, slot)
            if len(rest):
                self._write(slots, last, pa.Table.from_pandas(rest, _OPEN, preserve_index=False), int(rest["t"].min()))
        self._keep(slots)
        if slots:
            self.handle.registerTimer(min(rest[0] for rest in slots.values()) + self.limit_ms)
        yield _bodies([])

    def close(self) -> None:
        pass


def user_jumps(df: DataFrame, limit: str, tie: Sequence[str] = ()) -> DataFrame:
    _need_event_time(df)
    start = F.col("page.last_page_id").isNull().alias("start")
    timed = df.where(F.col("ts").isNotNull())  # a row without a time follows nothing and is not waited for
    packed = _pack(timed, F.pmod(F.xxhash64("common.mid"), F.lit(JUMP_LANES)), F.col("common.mid").cast("string").alias("mid"),
                   start, _pos(tie)).withColumn("body", F.when(F.col("start"), F.col("body")))
    out = packed.groupBy("k").transformWithStateInPandas(
        UserJumps(timefns.duration_ms(limit)), "body STRING", "Append", "EventTime")
    return _unpack(out, df)
