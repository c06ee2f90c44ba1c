"""Faults that were found once."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidehouse import sinks
from tidehouse.functions import mapfns, textfns
from tidehouse.operators import cells, changelog, logs, parse


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_second_call_of_a_batch_sink_keeps_the_first(spark, tmp_path):
    one, two = (spark.createDataFrame([(k, v, 1)], "k string, v string, ts long") for k, v in (("a", "x"), ("b", "y")))
    for part in (one, two):
        sinks.upsert(part, f"{tmp_path}/log", "k", "ts")
        sinks.ordered_append(part, f"{tmp_path}/rows", ["k", "v"])
    assert rows_of(sinks.read_upserted(spark, f"{tmp_path}/log", "k", "ts")) == [("a", "x", 1), ("b", "y", 1)]
    assert rows_of(spark.read.parquet(f"{tmp_path}/rows").select("k", "v")) == [("a", "x"), ("b", "y")]
    routed = [spark.createDataFrame([("t", {"id": n}, "1")], "sink_table string, data map<string,string>, ts string") for n in "12"]
    for part in routed:
        sinks.routed(part, f"{tmp_path}/routed")
    assert spark.read.text(f"{tmp_path}/routed").count() == 2


def test_new_checkpoint_keeps_the_log_of_the_old_one(spark, tmp_path):
    for number, key in enumerate("ab"):
        source = f"{tmp_path}/in{number}"
        spark.createDataFrame([(key, 1)], "k string, ts long").write.parquet(source)
        stream = spark.readStream.schema("k string, ts long").parquet(source)
        sinks.upsert(stream, f"{tmp_path}/log", "k", "ts", checkpoint=f"{tmp_path}/checkpoint{number}").awaitTermination()
    assert rows_of(sinks.read_upserted(spark, f"{tmp_path}/log", "k", "ts")) == [("a", 1), ("b", 1)]


def test_compacted_log_equals_the_log_on_ties(spark, tmp_path):
    for value in ("old", "new"):
        sinks.upsert(spark.createDataFrame([("a", value, 1)], "k string, v string, ts long"), f"{tmp_path}/log", "k", "ts")
    compact = changelog.compact(spark, f"{tmp_path}/log", f"{tmp_path}/small", "k", "ts")
    assert rows_of(compact) == rows_of(sinks.read_upserted(spark, f"{tmp_path}/log", "k", "ts")) == [("a", "new", 1)]


def test_words_keep_their_letters(spark):
    text = "Für Élève привет naïve ＡＢＣ１ 深空灰 中x2"
    row = spark.range(1).select(textfns.keywords(F.lit(text)).alias("w")).first()
    assert row.w == ["für", "élève", "привет", "naïve", "abc1", "深空", "空灰", "中", "x2"]
    textfns.register_sql(spark)
    spark.createDataFrame([(text,)], "t string").createOrReplaceTempView("texts")
    assert [r.word for r in spark.sql("SELECT word FROM texts, LATERAL keywords_of(t)").collect()] == row.w


def test_leading_white_space_is_no_dirt(spark):
    raw = spark.createDataFrame([("\t\n {\"ts\": \"1\"}",), ("x{}",)], "value string")
    good, dirty = parse.split_dirty(raw)
    assert good.count() == 1 and dirty.count() == 1


def test_whitelist_ignores_blanks_around_names(spark):
    df = spark.sql("SELECT map('id', '1', 'name', '2', 'x', '3') AS m, ' id , name' AS names")
    assert df.select(mapfns.whitelist("m", "names").alias("m")).first().m == {"id": "1", "name": "2"}


def test_quiet_input_holds_nothing_back_under_one_watermark(spark, tmp_path):
    from tidehouse import schemas
    from tidehouse.operators import window_sums

    page = spark.createDataFrame([(t * 60_000,) for t in range(120)], "ts long").select(
        F.from_json(F.lit('{"mid": "1", "vc": "v", "sc": "1", "ar": "1", "is_new": "0"}'), schemas.PAGE["common"].dataType).alias("common"),
        F.from_json(F.lit('{"page_id": "home"}'), schemas.PAGE["page"].dataType).alias("page"), "ts")
    for name in ("pages", "visitors", "jumps"):
        (page if name == "pages" else page.limit(0)).write.parquet(f"{tmp_path}/{name}")
    streams = [spark.readStream.schema(schemas.PAGE).parquet(f"{tmp_path}/{n}") for n in ("pages", "visitors", "jumps")]
    sums = window_sums.traffic_window(*streams, emit_time=False, one_watermark=True)
    sinks.append(sums, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.json(f"{tmp_path}/out").count() == 119  # the last window is still open


def test_undeclared_members_reach_the_outputs(spark):
    sent = ['{"common":{"mid":"a","is_new":"1","ip":"10.0.0.1"},"page":{"page_id":"home","refer_id":7},"err":{"code":1},'
            '"displays":[{"item":1}],"actions":["x"],"trace":{"id":"12"},"ab":"12","ts":100000000000}',
            '{"common":{"mid":"a","is_new":1,"ip":"10.0.0.2"},"appVideo":{"play_sec":1,"codec":"h"},"ts":"200000000000"}',
            '{"common":{"mid":"a","is_new":"0"},"start":{"entry":"x"},"lang":null,"net":[1.5],"ts":200000000001}']
    records = parse.drop_bad(spark.createDataFrame([(t,) for t in sent], "value string"), record=parse.RECORD)
    records = logs.repair_is_new(records, "UTC")
    tagged = [(r.output, json.loads(r.value)) for r in logs.split_tagged(records).collect()]
    common, page = {"mid": "a", "is_new": "1", "ip": "10.0.0.1"}, {"page_id": "home", "refer_id": 7}
    rest = {"common": common, "page": page, "trace": {"id": "12"}, "ab": "12", "ts": 100000000000}
    want = [
        ("error", rest | {"err": {"code": 1}, "displays": [{"item": 1}], "actions": ["x"]}),
        ("page", rest),
        ("display", {"display": {"item": 1}, "common": common, "page": page, "ts": 100000000000}),
        ("action", {"action": "x", "common": common, "page": page}),
        ("video", {"common": {"mid": "a", "is_new": "0", "ip": "10.0.0.2"}, "appVideo": {"play_sec": 1, "codec": "h"},
                   "ts": "200000000000"}),
        ("start", {"common": {"mid": "a", "is_new": "0"}, "start": {"entry": "x"}, "net": [1.5], "ts": 200000000001}),
    ]
    assert sorted(tagged, key=str) == sorted(want, key=str)
    split = logs.split_log(records)
    assert sorted(((name, json.loads(r.record)) for name, df in split.items() for r in df.collect()), key=str) == sorted(want, key=str)
    assert set(split["page"].columns) == {"common", "page", "ts", "record"}


def test_name_sent_twice_loses_no_members(spark):
    raw = spark.createDataFrame([('{"common":{"mid":"a","ip":"1","ip":"2"},"page":{"page_id":"x"},"net":1,"ts":5}',)], "value string")
    row, = logs.split_tagged(parse.drop_bad(raw, record=parse.RECORD)).collect()
    assert json.loads(row.value) == {"common": {"mid": "a", "ip": "2"}, "page": {"page_id": "x"}, "net": 1, "ts": 5}


def test_raw_scan_counts_only_puts_as_versions(spark):
    log = [("r", "f", "q", "a", 1, "Put"), ("r", "f", "q", "b", 2, "Put"), ("r", "f", "q", "c", 3, "Put"),
           ("r", "f", "q", None, 2, "DeleteColumn"), ("r", "f", "q", None, 4, "DeleteColumn"), ("r", "f", "q", None, 4, "Delete"),
           ("r", "f", None, None, 1, "DeleteFamily"), ("s", "f", "q", None, 9, "DeleteColumn")]
    made = spark.createDataFrame(log, "row string, family string, qualifier string, value string, ts long, type string")
    shown = cells.scan(made, "r", "s", versions=2, raw=True)
    assert sorted(map(tuple, shown.collect()), key=str) == sorted(log[1:7], key=str)
