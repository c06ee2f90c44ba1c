"""Positions of records, and keyed logs under compaction, retries and several writers."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidehouse import sinks, sources
from tidehouse.operators import changelog, config, dim
from tidehouse.sources import topics

SCHEMA = "k string, v string, ts long"


def table(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def lines(path, *texts):
    path.write_text("".join(f"{t}\n" for t in texts))


def test_positions_follow_files_and_lines(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    records = [[f'{{"k":"a","v":"{f}-{n}","ts":1}}' for n in range(2000)] for f in range(3)]
    import os
    for f, texts in enumerate(records):
        lines(folder / f"part-{9 - f}", *texts)
        os.utime(folder / f"part-{9 - f}", (1_700_000_000 + f, 1_700_000_000 + f))  # later files have smaller names
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        raw = sources.raw_topic(spark, str(folder), stream=False, position=True)
        assert raw.rdd.getNumPartitions() > 3
        rows = sources.json_table(raw, SCHEMA).orderBy("pos").select("v").collect()
        assert [r.v for r in rows] == [f"{f}-{n}" for f in range(3) for n in range(2000)]
        latest = changelog.latest_by_key(sources.json_table(raw, SCHEMA), "k", ["ts", "pos"])
        assert table(latest, "k", "v") == [("a", "2-1999")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sources.raw_topic(spark, str(folder), position=True).schema["pos"].dataType.simpleString() == sources.POSITION_TYPE


def test_positions_of_a_topic_are_partition_and_offset(spark):
    records = spark.createDataFrame([(b"x", 2, 10), (b"y", 10, 3), (b"z", 2, 9)], "value binary, partition int, offset long")
    found = topics._kafka_records(records, True).orderBy("pos").collect()
    assert [r.value for r in found] == ["z", "x", "y"] and found[0].pos.row == 9


def test_rule_changes_of_one_instant_count_in_order(spark, tmp_path):
    def change(op, columns):
        side = "before" if op == "d" else "after"
        return f'{{"op":"{op}","{side}":{{"source_table":"t","source_type":"insert","sink_table":"s","sink_columns":"{columns}"}},"ts_ms":5}}'

    from tidehouse import schemas
    for last, want in (("u", [("t", "c")]), ("d", [])):
        path = tmp_path / last
        path.mkdir()
        lines(path / "changes", change("u", "a"), change("d", "a"), change("u", "b"), change(last, "c"))
        changes = sources.rule_changes(sources.raw_topic(spark, str(path), stream=False, position=True), schemas.DETAIL_RULE)
        assert table(config.fold_changes(changes, ["ts_ms", "pos"]), "source_table", "sink_columns") == want


def test_a_retried_batch_counts_once_and_writers_are_ordered_by_time_of_writing(spark, tmp_path):
    path = str(tmp_path / "log")
    log = sinks.KeyedLog(spark, path)

    def write(value, writer, number, ts=1):
        log.append(spark.createDataFrame([("a", value, ts)], SCHEMA), writer, number)

    # whatever the writers' names
    for order in itertools.permutations(("w1", "w2", "w3")):
        for writer in order:
            write(writer, writer, log.state()["version"])
        assert table(sinks.read_upserted(spark, path, "k", "ts"), "v") == [(order[-1],)]
    parts = log.state()["parts"]
    write("again", order[-1], 0)  # an old batch of a writer that is beyond it
    assert log.state()["parts"] == parts
    sinks.upsert(spark.createDataFrame([("a", "table", 1)], SCHEMA), path, "k", "ts")
    write("stream after the table", "w9", 0)
    assert table(sinks.read_upserted(spark, path, "k", "ts"), "v") == [("stream after the table",)]


def test_a_stream_writes_while_the_log_is_compacted(spark, tmp_path):
    path, chance = str(tmp_path / "log"), random.Random(2)
    log, want, numbers = sinks.KeyedLog(spark, path), {}, itertools.count()

    def write():
        number = next(numbers)
        rows = [(f"k{chance.randrange(9)}", f"{number}-{i}", chance.randrange(5)) for i in range(8)]
        best = {}
        for i, (k, v, ts) in enumerate(rows):
            if k not in best or ts > best[k][1]:
                best[k] = (v, ts)
        log.append(spark.createDataFrame([(k, *v) for k, v in best.items()], SCHEMA), "stream", number)
        for k, (v, ts) in best.items():
            if k not in want or ts >= want[k][1]:
                want[k] = (v, ts)

    def fold(rows):
        write()  # between what the compaction read and its manifest
        return changelog.latest_by_key(rows, "k", ["ts", "_at"])

    for _ in range(3):
        for _ in range(3):
            write()
        log.compact(fold)
        parts = log.state()["parts"]
        assert parts[0].startswith("_levels/") and len(parts) == 2  # the level, and the batch that came meanwhile
        assert table(sinks.read_upserted(spark, path, "k", "ts"), "k", "v") == sorted((k, v) for k, (v, _) in want.items())
    streamed = spark.readStream.schema(f"{SCHEMA}, _at string").parquet(path)
    query = streamed.writeStream.format("memory").queryName("seen").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "seen")).start()
    query.awaitTermination()
    assert spark.table("seen").count() > len(want)  # every batch, no level
    gone = log.vacuum()
    assert gone and log.state()["parts"] == parts and log.vacuum() == []
    assert table(sinks.read_upserted(spark, path, "k", "ts"), "k", "v") == sorted((k, v) for k, (v, _) in want.items())


def test_two_compactions_at_once_keep_one_level(spark, tmp_path):
    path = str(tmp_path / "log")
    for value in "xyz":
        sinks.upsert(spark.createDataFrame([("a", value, 1), (value, value, 1)], SCHEMA), path, "k", "ts")

    def fold(rows):
        sinks.compact_upserted(spark, path, "k", "ts")
        return changelog.latest_by_key(rows, "k", ["ts", "_at"])

    log = sinks.KeyedLog(spark, path)
    log.compact(fold)
    assert len(log.state()["parts"]) == 1
    assert table(sinks.read_upserted(spark, path, "k", "ts"), "k", "v") == [("a", "z"), ("x", "x"), ("y", "y"), ("z", "z")]


RULE = {"source_table": "s", "sink_table": "d", "sink_columns": "id,a,b", "sink_pk": None, "sink_extend": None}
ROUTED = "sink_table string, ts string, data map<string,string>, deleted boolean, pos struct<source:string,row:bigint>"


def test_dimension_writes_of_one_instant_are_not_mixed(spark, tmp_path):
    root = str(tmp_path / "dims")
    both = [("d", "1", {"id": "1", "a": "Z", "b": "A"}, False, None), ("d", "1", {"id": "1", "a": "A", "b": "Z"}, False, None)]
    dim.upsert_dims(spark.createDataFrame(both, ROUTED), None, root, [RULE])
    assert table(dim.read_dim(spark, root, "d", "id,a,b"), "a", "b") in ([("Z", "A")], [("A", "Z")])
    again = [("d", "1", {"id": "2", "a": "x"}, True, None), ("d", "1", {"id": "2", "a": "y"}, False, None)]
    dim.upsert_dims(spark.createDataFrame(again, ROUTED), None, root, [RULE])
    assert ("2", "y", None) in table(dim.read_dim(spark, root, "d", "id,a,b"), "id", "a", "b")


@pytest.mark.parametrize("seed", range(3))
def test_a_compacted_dimension_reads_the_same_whatever_comes_later(spark, tmp_path, seed):
    chance = random.Random(seed)
    events = []
    for row in range(60):
        data = {"id": str(chance.randrange(6))} | {c: f"{c}{row}" for c in "ab" if chance.random() < 0.6}
        events.append(("d", str(chance.randrange(8)), data, chance.random() < 0.2, ("0", row)))
    chance.shuffle(events)  # late events fall between compacted ones
    want = {}
    for _, _, data, gone, _ in sorted(events, key=lambda e: (int(e[1]), e[4][1])):
        if gone:
            want.pop(data["id"], None)
        else:
            want.setdefault(data["id"], {}).update(data)
    root = str(tmp_path / "dims")
    for number, first in enumerate(range(0, 60, 15)):
        dim.upsert_dims(spark.createDataFrame(events[first:first + 15], ROUTED), number, root, [RULE], "w")
        dim.compact_dim(spark, root, "d", "id,a,b")
    assert len(sinks.KeyedLog(spark, dim.table_path(root, "d")).state()["parts"]) == 1
    rows = table(dim.read_dim(spark, root, "d", "id,a,b").select("id", F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))), "*")
    assert rows == sorted((k, v.get("a", ""), v.get("b", "")) for k, v in want.items())


def test_rules_in_force_at_an_event(spark):
    """A replay routes every event by the rule of its own time."""
    from tidehouse import schemas
    from tidehouse.operators import cdc
    rule = lambda sink, columns: ("t", "insert", sink, columns)
    changes = spark.createDataFrame([
        ("c", None, rule("one", "id"), 10, 1), ("u", None, rule("skipped", "id"), 20, 1), ("u", rule("skipped", "id"), rule("two", "id,v"), 20, 2),
        ("d", rule("two", "id,v"), None, 30, 1), ("u", None, rule("three", "v"), 40, 1)],
        f"op string, before struct<{ddl(schemas.DETAIL_RULE)}>, after struct<{ddl(schemas.DETAIL_RULE)}>, ts_ms long, pos int")
    events = spark.createDataFrame([("db", "t", "insert", {"id": str(n), "v": "x"}, ts) for n, ts in enumerate(
        ("9", "10", "19", "20", "29", "30", "39", "40", "99", "no time", None))], schemas.CHANGE)
    routed = cdc.route_detail_as_of(events, config.rule_versions(changes, ["ts_ms", "pos"]))
    assert sorted((r.ts, r.sink_table, len(r.data)) for r in routed.collect()) == [
        ("10", "one", 1), ("19", "one", 1), ("20", "two", 2), ("29", "two", 2), ("40", "three", 1), ("99", "three", 1)]


def ddl(schema):
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields)
