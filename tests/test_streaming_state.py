"""Streaming forms against their batch twins, over several micro-batches with rows out of order."""

import random

import pytest
from pyspark.sql import functions as F

import streams
from tidehouse.functions import timefns
from tidehouse.operators import learn, logs, traffic, user, window_sums
from tidehouse.streaming import stateful

DAY = 86_400_000
BASE = 1_700_000_000_000


def batches(seed, devices=4, rows=240, step=4_000, disorder=3_000, size=40):
    """Rows in rough time order: each may be up to ``disorder`` late; a far-future row flushes the watermark."""
    rng = random.Random(seed)
    made = []
    for n in range(rows):
        ts = BASE + n * step + rng.randrange(step)
        made.append((ts + rng.randrange(disorder), streams.log_row(
            f"m{rng.randrange(devices)}", ts, last=rng.choice([None, None, "home"]), uid=rng.choice(["u", None]),
            is_new=rng.choice("01"))))
    made.sort(key=lambda pair: pair[0])
    ordered = [row for _, row in made]
    return [ordered[at:at + size] for at in range(0, rows, size)] + [[streams.log_row("flush", streams.FAR, last="x")]]


def keys(df):
    return sorted((r.mid, r.ts, r.is_new) for r in df.where(F.col("common.mid") != "flush").select(
        "common.mid", "ts", "common.is_new").collect())


@pytest.mark.parametrize("name,delay,step", [
    ("unique_visitors", "1 minute", 1_800_000), ("user_jumps", "5 seconds", 4_000), ("first_login", "5 seconds", 3_600_000)])
def test_stream_equals_batch(spark, tmp_path, name, delay, step):
    src = str(tmp_path / "src")
    streams.write_files(src, batches(7, step=step, disorder=3_000))
    operator = {
        "unique_visitors": lambda df: traffic.unique_visitors(df, "UTC"),
        "user_jumps": lambda df: traffic.user_jumps(df),
        "first_login": lambda df: user.first_login(df),
    }[name]
    got = streams.run(operator(streams.read_stream(spark, src, delay)), str(tmp_path / "out"), str(tmp_path / "cp"))
    want = operator(streams.read_batch(spark, src))
    assert keys(got) == keys(want)
    assert keys(want)


def test_is_new_stream_equals_batch_in_order(spark, tmp_path):
    src = str(tmp_path / "src")
    nobody = [streams.log_row(None, BASE + n * DAY, is_new="1") for n in range(3)]
    streams.write_files(src, batches(3, step=1_800_000, disorder=1) + [nobody])
    got = streams.run(logs.repair_is_new(streams.read_stream(spark, src), "UTC"), str(tmp_path / "out"), str(tmp_path / "cp"))
    want = logs.repair_is_new(streams.read_batch(spark, src), "UTC")
    assert keys(got) == keys(want)
    for df in (got, want):
        assert [r.is_new for r in df.where("common.mid is null").select("common.is_new").collect()] == ["1"] * 3


def test_restart_loses_and_repeats_nothing(spark, tmp_path):
    src, all_batches = str(tmp_path / "src"), batches(11)
    streams.write_files(src, all_batches[:3])
    job = lambda: traffic.user_jumps(streams.read_stream(spark, src, "5 seconds"))
    streams.run(job(), str(tmp_path / "out"), str(tmp_path / "cp"))
    streams.write_files(src, all_batches)
    got = streams.run(job(), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert keys(got) == keys(traffic.user_jumps(streams.read_batch(spark, src)))


def test_late_rows_are_dropped(spark, tmp_path):
    row, src = streams.log_row, str(tmp_path / "src")
    # A batch judges lateness by the watermark the batch before it started with.
    streams.write_files(src, [[row("a", BASE)], [row("a", BASE + 120_000)], [row("a", BASE + 120_001)],
                              [row("a", BASE + 1_000)], [row("a", streams.FAR)]])
    rows = streams.read_stream(spark, src)
    sums = window_sums.traffic_window(rows, rows, rows, tz="UTC", emit_time=False)
    got = streams.run(sums, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted((r.stt, r.pageViewCount) for r in got.collect()) == [
        ("2023-11-14 22:13:20", 1), ("2023-11-14 22:15:20", 2)]


def test_play_sessions_over_several_files(spark, tmp_path):
    """Sessions cross files; the position of the latest row counts though an earlier row arrives after it."""
    rng, src, made = random.Random(5), str(tmp_path / "src"), []
    for n in range(200):
        ts = BASE + n * 900 + rng.randrange(900)
        video = {"play_sec": rng.randrange(20), "video_id": f"v{n}", "position_sec": rng.randrange(1000)}
        made.append((ts + rng.randrange(4_000), streams.log_row("m", ts, uid="u", sid=f"s{rng.randrange(3)}", appVideo=video)))
    ordered = [row for _, row in sorted(made, key=lambda pair: pair[0])]
    flush = streams.log_row("flush", streams.FAR, uid="u", sid="flush", appVideo={"play_sec": 1, "video_id": "v", "position_sec": 1})
    streams.write_files(src, [ordered[at:at + 30] for at in range(0, 200, 30)] + [[flush]])
    plays = timefns.with_event_time(logs.flatten_play(streams.read_stream(spark, src)), delay="10 seconds")
    got = streams.run(learn.play_sessions(plays), str(tmp_path / "out"), str(tmp_path / "cp"))
    want = learn.play_sessions(logs.flatten_play(streams.read_batch(spark, src)))
    rows = sorted(map(tuple, want.where("sessionId <> 'flush'").collect()))
    assert sorted(map(tuple, got.where("sessionId <> 'flush'").collect())) == rows and len(rows) > 3


def test_bounces_keep_state_of_several_files(spark, tmp_path):
    """Rows of one slot in several files, rows at the very ends of slots, and ties, out of order within the delay."""
    rng, src, made = random.Random(2), str(tmp_path / "src"), []
    for n in range(150):
        ts = BASE + n * 1_500 + rng.choice([0, 0, 1, 499, 500])
        made.append((ts + rng.randrange(8_000), streams.log_row(f"m{rng.randrange(2)}", ts, last=rng.choice([None, "home"]))))
    ordered = [row for _, row in sorted(made, key=lambda pair: pair[0])]
    streams.write_files(src, [ordered[at:at + 7] for at in range(0, 150, 7)] + [[streams.log_row("flush", streams.FAR, last="x")]])
    got = streams.run(traffic.user_jumps(streams.read_stream(spark, src, "15 seconds"), "3 seconds"),
                      str(tmp_path / "out"), str(tmp_path / "cp"))
    want = traffic.user_jumps(streams.read_batch(spark, src), "3 seconds")
    assert keys(got) == keys(want) and len(keys(want)) > 10


def test_bounces_take_state_by_lanes_not_devices(spark, tmp_path, monkeypatch):
    """Many devices, and rows without one, in few lanes: right rows, with state entries by lane and slot of time."""
    monkeypatch.setattr(stateful, "JUMP_LANES", 4, raising=False)
    monkeypatch.setattr(stateful, "JUMP_ROWS", 50, raising=False)
    rng, src = random.Random(3), str(tmp_path / "src")
    rows = [streams.log_row(rng.choice([None, *(f"m{d}" for d in range(120))]), BASE + rng.randrange(40_000),
                            last=rng.choice([None, "home"])) for _ in range(600)]
    streams.write_files(src, [rows, [streams.log_row("flush", streams.FAR, last="x")]])
    df = traffic.user_jumps(streams.read_stream(spark, src, "0 seconds"))
    query = df.writeStream.format("memory").queryName("bounces_by_lane").option("checkpointLocation", str(tmp_path / "cp")) \
        .trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    want = traffic.user_jumps(streams.read_batch(spark, src))
    found = sorted((r.mid or "", r.ts) for r in spark.table("bounces_by_lane").select("common.mid", "ts").collect())
    assert found == sorted((r.mid or "", r.ts) for r in want.select("common.mid", "ts").collect()) and len(found) > 50
    written = [state["numRowsUpdated"] for p in query.recentProgress for state in p["stateOperators"]]
    assert max(written) < 4 * 6 * 4  # lanes, slots with their tables and timers; there are 120 devices
