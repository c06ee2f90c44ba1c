"""Edges of single operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import streams
from tidehouse import schemas, sinks, sized, sources
from tidehouse.functions import mapfns, textfns, timefns
from tidehouse.operators import cdc, cells, changelog, config, dim, keywords, learn, logs, parse, traffic, user
from tidehouse.operators import window_sums

DAY = 86_400_000
BASE = 1_700_000_000_000


def log(spark, rows):
    return spark.createDataFrame(
        [(dict(r["common"]), dict(r["page"]), None, None, None, None, None, r["ts"]) for r in rows],
        schemas.LOG, verifySchema=False)


def got(df, *names):
    return sorted(map(tuple, df.select(*names).collect()), key=str)


# ---------------------------------------------------------------- parsing

BOUNCE_INPUT = [
    '{"common":{"mid":"101"},"page":{"page_id":"home"},"ts":10000} ',
    '{"common":{"mid":"102"},"page":{"page_id":"home"},"ts":12000}',
    '{"common":{"mid":"102"},"page":{"page_id":"good_list"},"ts":15000} ',
    '{"common":{"mid":"102"},"page":{"page_id":"good_list","last_page_id":"detail"},"ts":30000}',
]


def test_bounce_fixture(spark):
    raw = spark.createDataFrame([(text,) for text in BOUNCE_INPUT], "value string")
    assert got(traffic.user_jumps(parse.drop_bad(raw)), "common.mid", "ts") == [
        ("101", 10000), ("102", 12000), ("102", 15000)]


@pytest.mark.parametrize("text,is_dirty", [
    ("{bad", True), ("", True), ("[1]", True), ('[{"ts":1}]', True), ("12", True), ("null", True),
    ('{"ts":1', True), ("{}", False), (' {"ts":"7"}', False), ('{"ts":1,"unknown":[1,2]}', False)])
def test_dirty(spark, text, is_dirty):
    good, dirty = parse.split_dirty(spark.createDataFrame([(text, 5)], "value string, pos int"))
    assert [tuple(r) for r in dirty.collect()] == ([(text, 5)] if is_dirty else [])
    assert good.count() == (0 if is_dirty else 1)
    assert good.columns == ["pos"] + schemas.LOG.fieldNames()


def test_numbers_as_text_and_bad_numbers(spark):
    raw = spark.createDataFrame([('{"page":{"during_time":"12"},"ts":"x"}',)], "value string")
    row = parse.strict(raw).first()
    assert (row.page.during_time, row.ts, row.common) == (12, None, None)


def test_strict_fails(spark):
    raw = spark.createDataFrame([("{bad",)], "value string")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        parse.strict(raw).collect()


def test_sources(spark, tmp_path):
    streams.write_files(str(tmp_path / "t"), [['{"common":{"mid":"1"},"page":{"page_id":"p"},"ts":1999}', ""]])
    raw = sources.raw_topic(spark, str(tmp_path / "t"), stream=False)
    assert raw.count() == 1
    row = sources.page_log(raw).first()
    assert (row.common.mid, row.row_time.replace(tzinfo=dt.timezone.utc).timestamp()) == ("1", 1)
    maps = sources.json_table(raw, schemas.PAGE_MAPS).first()
    assert (maps.common, maps.page, maps.ts) == ({"mid": "1"}, {"page_id": "p"}, 1999)
    event = spark.createDataFrame([('{"database":"a","table":"t","type":"insert","data":{"id":1},"ts":"3"}',)], "value string")
    assert sources.change_events(event, "a").first().data == {"id": "1"}
    assert sources.change_events(event, "b").count() == 0
    assert sources.kafka_options("h:1", "t", "earliest")["startingOffsets"] == "earliest"
    starts = [sources.kafka_options("h:1", "t", table=table)["startingOffsets"] for table in (False, True)]
    assert starts == ["latest", "earliest"]
    with pytest.raises(ValueError):
        sources.kafka_options("h:1", "t", "middle")
    with pytest.raises(ValueError):
        sources.raw_topic(spark)


def test_lookup_reaches_the_scan(spark, folder):
    df = sources.lookup_rows(sources.table(spark, f"{folder}/customer.parquet", "parquet"), ("c_nationkey", 7),
                             c_mktsegment="BUILDING").select("c_custkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_nationkey,7)" in plan and "EqualTo(c_mktsegment,BU" in plan and "c_acctbal" not in plan


# ---------------------------------------------------------------- functions

def test_time_functions(spark):
    df = spark.createDataFrame([(1_700_000_000_123,), (-1,), (None,)], "ts bigint")
    rows = df.select(timefns.to_date_text("ts"), timefns.to_datetime_text("ts"), timefns.to_datetime_text("ts", "UTC"),
                     F.unix_seconds(timefns.row_time("ts"))).collect()
    assert tuple(rows[0]) == ("2023-11-15", "2023-11-15 06:13:20", "2023-11-14 22:13:20", 1_700_000_000)
    assert rows[1][3] == -1 and tuple(rows[2]) == (None,) * 4
    back = spark.createDataFrame([("2023-11-15", "2023-11-15 06:13:20")], "d string, f string").select(
        timefns.to_millis("d"), timefns.to_millis("f", True), timefns.date_of_text("f")).first()
    assert tuple(back) == (1_699_977_600_000, 1_700_000_000_000, "2023-11-15")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_time_does_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1_700_000_000_123, "2023-11-15 06:13:20")], "ts bigint, text string")
        row = df.select(timefns.to_datetime_text("ts"), timefns.to_millis("text", True),
                        F.col("ts") - F.unix_millis(F.timestamp_millis("ts"))).first()
        assert tuple(row) == ("2023-11-15 06:13:20", 1_700_000_000_000, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_durations():
    assert timefns.duration_ms("1 day 2 hours") == DAY + 7_200_000
    with pytest.raises(ValueError):
        timefns.duration_ms("soon")


def test_whitelist(spark):
    df = spark.createDataFrame([({"id": "1", "user": "2", "user_id": "3", "a,b": "4"},)], "data map<string,string>")
    assert set(df.select(mapfns.whitelist("data", F.lit("user_id,id"))).first()[0]) == {"id", "user_id"}
    assert set(df.select(mapfns.whitelist("data", F.lit("user_id"), "substring")).first()[0]) == {"id", "user", "user_id"}
    assert set(df.select(mapfns.whitelist("data", F.lit("x,a,b"))).first()[0]) == set()


def test_keywords(spark):
    text = "Apple iPhoneXSMax (A2104) 256GB 深空灰色 移动联通电信4G手机 双卡双待 Ｆｕｌｌ 灰 été"
    words = spark.createDataFrame([(text,), (None,), ("",)], "full_word string")
    assert words.select(textfns.keywords("full_word")).first()[0] == [
        "apple", "iphonexsmax", "a2104", "256gb", "深空", "空灰", "灰色", "移动", "动联", "联通", "通电", "电信", "4g",
        "手机", "双卡", "卡双", "双待", "full", "灰", "été"]
    assert keywords.explode_tokens(words).count() == 20
    known = spark.createDataFrame([("Apple",), ("手机",)], "word string")
    assert got(keywords.explode_tokens(words, dictionary=known), "keyword") == [("apple",), ("手机",)]


def test_keywords_in_sql(spark):
    textfns.register_sql(spark, "keywords_of")
    text = "Don't stop: iPhone 深空灰色 \\\\ Ｆｕｌｌ 灰"
    spark.createDataFrame([(text, 1), (None, 2)], "full_word string, n int").createOrReplaceTempView("search_table")
    rows = spark.sql("SELECT keyword, n FROM search_table, LATERAL keywords_of(full_word) AS t(keyword)")
    assert [r.keyword for r in rows.collect()] == spark.table("search_table").select(
        textfns.keywords("full_word")).first()[0] == ["don", "t", "stop", "iphone", "深空", "空灰", "灰色", "full", "灰"]


# ---------------------------------------------------------------- log

def test_is_new_repair(spark):
    row = streams.log_row
    rows = log(spark, [
        row("a", BASE, is_new="1"), row("a", BASE + DAY, is_new="1"), row("a", BASE + DAY, is_new="0"),
        row("b", BASE + DAY, is_new="0"), row("b", BASE + DAY + 1, is_new="1"), row("c", BASE, is_new=None),
        row(None, BASE, is_new="1")])
    assert got(logs.repair_is_new(rows, "UTC"), "common.mid", "ts", "common.is_new") == sorted([
        ("a", BASE, "1"), ("a", BASE + DAY, "0"), ("a", BASE + DAY, "0"), ("b", BASE + DAY, "0"),
        ("b", BASE + DAY + 1, "0"), ("c", BASE, None), (None, BASE, "1")], key=str)


def test_bounce_limit_is_exclusive(spark):
    row = streams.log_row
    rows = log(spark, [row("a", BASE), row("a", BASE + 10_000, last="x"), row("b", BASE), row("b", BASE + 9_999, last="x")])
    assert got(traffic.user_jumps(rows), "common.mid", "ts") == [("a", BASE)]


def hot_log(spark, n, seed=1, step=700):
    """Rows of which one device has a third."""
    rng = random.Random(seed)
    rows, ts = [], BASE
    for _ in range(n):
        ts += rng.randrange(step)
        rows.append(streams.log_row("hot" if rng.random() < 0.34 else f"m{rng.randrange(40)}", ts,
                                    last=rng.choice([None, "x", "x"]), uid=rng.choice(["u", None])))
    order = list(range(n))
    rng.shuffle(order)
    return rows, log(spark, [rows[i] for i in order])


@pytest.mark.parametrize("span", [1, 2, 8])
def test_jumps_against_brute_force(spark, span):
    rows, df = hot_log(spark, 3000)
    by_mid, want = {}, []
    for r in rows:
        by_mid.setdefault(r["common"]["mid"], []).append(r)
    for mid, mine in by_mid.items():
        # Equal times have no order of their own in this check.
        for at, r in enumerate(mine):
            following = mine[at + 1] if at + 1 < len(mine) else None
            if "last_page_id" not in r["page"] and (
                    following is None or following["ts"] - r["ts"] >= 2_000 or "last_page_id" not in following["page"]):
                want.append((mid, r["ts"]))
    assert len({(r["common"]["mid"], r["ts"]) for r in rows}) == len(rows)
    assert got(traffic.user_jumps(df, "2 seconds", span=span), "common.mid", "ts") == sorted(want, key=str)


@pytest.mark.parametrize("slots", [1, 3, 50, 5000])
def test_first_login_against_brute_force(spark, slots):
    rows, df = hot_log(spark, 3000, seed=4)
    opened, want = {}, []
    for r in rows:
        mid = r["common"]["mid"]
        if "uid" in r["common"] and r["ts"] >= opened.get(mid, -1) + 20_000:
            opened[mid] = r["ts"]
            want.append((mid, r["ts"]))
    assert got(user.first_login(df, hold="20 seconds", slots_per_hold=slots), "common.mid", "ts") == sorted(want, key=str)


def test_play_sessions(spark):
    def play(sid, ts, sec, position):
        return ("s", "p", "u", "o", "c", "0", "m", f"mid{ts}", "v", "b", sid, sec, position, "v1", ts)
    plays = spark.createDataFrame([
        play("a", BASE, 1, 50), play("a", BASE + 3_000, 2, 10), play("a", BASE + 6_001, 4, 70),
        play("b", BASE + 2_000, 8, 5), play("b", BASE, 16, 9)],
        ", ".join(f"{n} {'int' if n.endswith('Sec') else 'bigint' if n == 'ts' else 'string'}" for n in schemas.PLAY_COLUMNS))
    for span in (1, 2, 200):
        assert got(learn.play_sessions(plays, span=span), "sessionId", "ts", "playSec", "positionSec", "machineId") == [
            ("a", BASE, 3, 10, f"mid{BASE}"), ("a", BASE + 6_001, 4, 70, f"mid{BASE + 6_001}"),
            ("b", BASE, 24, 5, f"mid{BASE}")]


def test_metrics_treat_missing_time_as_zero(spark):
    row = window_sums.page_metrics(log(spark, [streams.log_row("a", BASE, during=None)])).first()
    assert (row.totalDuringTime, row.totalSessionCount, row.pageViewCount) == (0, 1, 1)


def test_group_key_is_not_concatenated(spark):
    a, b = streams.log_row("a", BASE), streams.log_row("a", BASE)
    a["common"].update(sc="1", vc="23"), b["common"].update(sc="12", vc="3")
    rows = log(spark, [a, b])
    assert window_sums.traffic_window(rows, rows.limit(0), rows.limit(0)).count() == 2


# ---------------------------------------------------------------- change events

def test_control_events(spark):
    kinds = ["insert", "update", "delete", "bootstrap-start", "bootstrap-insert", "bootstrap-complete", None]
    events = spark.createDataFrame([("d", "t", kind, {"id": "1"}, "1") for kind in kinds], schemas.CHANGE)
    assert got(cdc.drop_control(events), "type") == [("delete",), ("insert",), ("update",)]
    assert got(cdc.drop_control(events, True), "type") == [("bootstrap-insert",), ("delete",), ("insert",), ("update",)]


def test_rules(spark):
    schema = f"n int, op string, before struct<{'source_table string, sink_table string'}>, after struct<source_table string, sink_table string>"
    changes = spark.createDataFrame([
        (1, "c", None, ("a", "x")), (2, "u", ("a", "x"), ("a", "y")), (3, "c", None, ("b", "z")), (4, "d", ("b", "z"), None),
        (5, "d", ("stored2", "q"), None), (6, None, None, ("d", "w"))], schema)
    assert got(config.fold_changes(changes, "n"), "source_table", "sink_table") == [("a", "y"), ("d", "w")]
    stored = spark.createDataFrame([("a", "old"), ("stored", "p"), ("stored2", "q")], "source_table string, sink_table string")
    assert got(config.load_rules(stored, changes, "n"), "source_table", "sink_table") == [
        ("a", "y"), ("d", "w"), ("stored", "p")]
    assert got(config.load_rules(stored), "source_table") == [("a",), ("stored",), ("stored2",)]


def test_small_side_checks_size(spark):
    df = spark.range(1000)
    assert sized.estimated_bytes(df) == 8000
    assert "ResolvedHint" in sized.small_side(df)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in sized.small_side(df, 100)._jdf.queryExecution().analyzed().toString()
    unknown = spark.createDataFrame([(n,) for n in range(5)], "n int")
    for probe, hinted in ((0, False), (4, False), (5, True)):
        analyzed = sized.small_side(unknown, probe_rows=probe)._jdf.queryExecution().analyzed().toString()
        assert ("ResolvedHint" in analyzed) == hinted


def test_rule_changes_from_text(spark):
    raw = spark.createDataFrame([
        ('{"op":"r","before":null,"after":{"source_table":"a","source_type":"insert","sink_table":"x","sink_columns":"id"},"ts_ms":1}',),
        ('{"op":"u","before":{"source_table":"a"},"after":{"source_table":"a","source_type":"update","sink_table":"y","sink_columns":"id"},"ts_ms":2}',),
    ], "value string")
    rules = config.load_rules(changes=sources.rule_changes(raw, schemas.DETAIL_RULE))
    assert got(rules, *schemas.DETAIL_RULE.fieldNames()) == [("a", "update", "y", "id")]


# ---------------------------------------------------------------- keyed tables, dimensions, sinks

def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"), ("b", 0, "w"), (None, 1, "n")],
                               "k string, n int, v string")
    assert got(changelog.latest_by_key(df, "k", "n"), "k", "v") == [("a", "y"), ("b", "w"), (None, "n")]


def test_upsert_log(spark, tmp_path):
    path = str(tmp_path / "u")
    schema = "id string, v string, n int"
    sinks.upsert(spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 1)], schema), path, "id", "n")
    assert got(sinks.read_upserted(spark, path, "id", "n"), "id", "v") == [("a", "2"), ("b", "3")]
    sinks.upsert(spark.createDataFrame([("a", "4", 2)], schema), path, "id", "n")
    assert got(sinks.read_upserted(spark, path, "id", "n"), "id", "v") == [("a", "4"), ("b", "3")]
    compacted = changelog.compact(spark, path, str(tmp_path / "c"), "id", "n")
    assert got(compacted, "id", "v") == [("a", "4"), ("b", "3")]


def test_kafka_messages(spark):
    df = spark.createDataFrame([("t1", 1, "x")], "to string, id int, v string")
    row = sinks.kafka_message(df, ["id"], "to").first()
    assert (row.topic, row.key, row.value) == ("t1", '{"id":1}', '{"id":1,"v":"x"}')
    assert sinks.kafka_message(df).first().key == sinks.kafka_message(df).first().key
    assert sinks.kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_ordered_append(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, b int")
    sinks.ordered_append(df, str(tmp_path / "o"), ["a", "b", "c"], ["b"])
    assert spark.read.parquet(str(tmp_path / "o")).columns == ["a", "c", "batch"]


def test_ensure_table(spark, tmp_path):
    root = str(tmp_path / "dims")
    for _ in range(2):
        dim.ensure_table(spark, root, "d", "id,name", None, "compression=gzip")
    table = dim.read_dim(spark, root, "d", "id,name")
    assert table.count() == 0 and {f.dataType.simpleString() for f in table.schema} == {"string"}
    with pytest.raises(ValueError):
        dim.ensure_table(spark, root, "e", "name,other")


def test_upsert_dims_is_idempotent_and_partial(spark, tmp_path):
    root = str(tmp_path / "dims")
    rule = {"source_table": "s", "sink_table": "d", "sink_columns": "id,a,b", "sink_pk": None, "sink_extend": None}
    routed = "sink_table string, ts string, data map<string,string>"
    first = spark.createDataFrame([("d", "1", {"id": "1", "a": "x", "b": "y"})], routed)
    second = spark.createDataFrame([("d", "2", {"id": "1", "b": "z"}), ("other", "2", {"id": "9"})], routed)
    dim.upsert_dims(first, 0, root, [rule])
    for _ in range(2):
        dim.upsert_dims(second, 1, root, [rule])
    assert got(dim.read_dim(spark, root, "d", "id,a,b"), "id", "a", "b") == [("1", "x", "z")]


def test_merge_partial_with_removal(spark):
    log_rows = spark.createDataFrame([
        ("1", "a", "b", 1, False), ("1", None, None, 2, True), ("1", "c", None, 3, False), ("2", "x", "y", 1, False),
        ("2", None, None, 5, True)], "id string, p string, q string, _seq bigint, _deleted boolean")
    assert got(dim.merge_partial(log_rows, "id"), "id", "p", "q") == [("1", "c", None)]


def test_enrich(spark):
    facts = spark.createDataFrame([("1", "p"), ("2", "q"), (None, "r")], "k string, v string")
    names = spark.createDataFrame([("1", "z"), ("1", "a"), ("3", "c")], "ID string, NAME string")
    assert got(dim.enrich(facts, names, {"k": "ID"}, {"name": "NAME"}), "v", "name") == [
        ("p", "a"), ("q", None), ("r", None)]


# ---------------------------------------------------------------- cells

def test_cells(spark):
    def rows(*values):
        return spark.createDataFrame(values, "row string, family string, qualifier string, value string")
    made = cells.put(rows(("1001", "f1", "name", "jack"), ("1001", "f1", "age", "20"), ("1001", "f2", "name", "jack2")), F.lit(1)) \
        .unionByName(cells.put(rows(("1001", "f1", "name", "joe"), ("1009", "f1", "name", "out")), F.lit(2)))
    assert got(cells.latest(made, "1001"), "family", "qualifier", "value") == [
        ("f1", "age", "20"), ("f1", "name", "joe"), ("f2", "name", "jack2")]
    assert cells.scan(made, "1001", "1009", versions=10).count() == 4
    name = rows(("1001", "f1", "name", None))
    one_less = made.unionByName(cells.delete_latest(made, name))
    assert got(cells.latest(one_less, "1001").where("family='f1'"), "qualifier", "value") == [("age", "20"), ("name", "jack")]
    no_column = made.unionByName(cells.delete(name, cells.DELETE_COLUMN, F.lit(2)))
    assert got(cells.latest(no_column, "1001"), "family", "qualifier") == [("f1", "age"), ("f2", "name")]
    no_family = made.unionByName(cells.delete(name, at_ms=F.lit(1)))
    assert got(cells.latest(no_family, "1001"), "family", "value") == [("f1", "joe"), ("f2", "jack2")]
    assert cells.scan(no_family, "1001", "1009", 10, raw=True).count() == 5
    with pytest.raises(ValueError):
        cells.delete(name, "Nothing")
