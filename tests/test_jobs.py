"""Whole pipelines over text topics, and their sinks."""

import json
import random

import pytest

import streams
from tidehouse import schemas, sinks, sources
from tidehouse.functions import timefns
from tidehouse.operators import dim, learn, logs, parse, trade, traffic, user, window_sums
from tidehouse.plans import jobs

BASE = 1_700_000_000_000


def topic(spark, path, **options):
    return sources.raw_topic(spark, path, maxFilesPerTrigger="1", **options)


def done(queries):
    for query in queries if isinstance(queries, list) else [queries]:
        query.awaitTermination(240)
        assert not query.isActive
        if query.exception() is not None:
            raise query.exception()


def lines(spark, path):
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


def test_log_layer(spark, tmp_path):
    src, out, cp = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "cp")
    row = streams.log_row
    streams.write_files(src, [
        [row("a", BASE, is_new="1", uid="u", displays=[{"item": "1"}, {"item": "2"}], actions=[]), "{broken", ""],
        [row("a", BASE + 86_400_000, is_new="1", last="home", err={"code": 1}), row("a", BASE + 1, start={"entry": "x"}),
         row("b", BASE + 2, sid="s", appVideo={"play_sec": 3, "video_id": "v", "position_sec": 9}, err={"code": 2})],
        [row("b", BASE + 3, actions=[{"do": "x"}]), "[1]"],
    ])
    done(jobs.split_site_log(topic(spark, src), out, cp, "UTC"))
    read = {name: lines(spark, f"{out}/output={name}") for name in
            ("dwd_traffic_page_log", "dwd_traffic_start_log", "dwd_traffic_display_log", "dwd_traffic_action_log",
             "dwd_traffic_error_log", "dwd_traffic_play_pre_process")}
    assert sorted(r.value for r in spark.read.text(f"{out}/output=dirty_data").collect()) == ["[1]", "{broken"]
    pages = sorted(read["dwd_traffic_page_log"], key=lambda r: r["ts"])
    assert [(p["common"]["mid"], p["common"]["is_new"]) for p in pages] == [("a", "1"), ("b", "0"), ("a", "0")]
    assert all(set(p) == {"common", "page", "ts"} for p in pages)
    assert read["dwd_traffic_start_log"][0]["start"] == {"entry": "x"}
    assert sorted(d["display"]["item"] for d in read["dwd_traffic_display_log"]) == ["1", "2"]
    assert [set(a) for a in read["dwd_traffic_action_log"]] == [{"action", "common", "page"}]
    assert sorted(e["err"]["code"] for e in read["dwd_traffic_error_log"]) == [1, 2]
    video, = read["dwd_traffic_play_pre_process"]
    assert "err" not in video and video["appVideo"] == {"play_sec": 3, "video_id": "v", "position_sec": 9}


def page_batches(seed, n=160):
    rng = random.Random(seed)
    rows = [streams.log_row(f"m{rng.randrange(5)}", BASE + i * 2_000 + rng.randrange(2_000),
                            last=rng.choice([None, "home"]), uid=rng.choice(["1", "2", None]), page=rng.choice(["order", "x"]),
                            sid=f"s{rng.randrange(6)}") for i in range(n)]
    for r in rows:
        if rng.random() < 0.5:
            r["page"].update(item="Spark 流处理 spark", item_type="keyword")
    flush = streams.log_row("flush", streams.FAR, last="x")
    flush["page"].update(item="end", item_type="keyword")
    return [rows[at:at + 40] for at in range(0, n, 40)] + [[flush]]


def test_summary_layer(spark, tmp_path):
    src, out, cp = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "cp")
    streams.write_files(src, page_batches(5))
    pages = sources.raw_topic(spark, src, stream=False)
    records = parse.strict(pages, typed=schemas.PAGE)
    flush = records.where("common.mid = 'flush'")
    visitors, jumps = traffic.unique_visitors(records, "UTC"), traffic.user_jumps(records)
    for name, rows in (("uv", visitors), ("jump", jumps)):
        sinks.to_json_value(rows.unionByName(flush)).coalesce(1).write.text(str(tmp_path / name))
    names = spark.createDataFrame([("2", "web")], "ID string, SOURCE_SITE string")
    areas = spark.createDataFrame([("9", "nowhere")], "ID string, NAME string")
    done(jobs.traffic_sums(topic(spark, src), topic(spark, str(tmp_path / "uv")), topic(spark, str(tmp_path / "jump")),
                           names, areas, out, cp, delay="10 minutes", tz="UTC", one_watermark=False))
    got = spark.read.parquet(f"{out}/{jobs.TRAFFIC_SUMS}")
    assert tuple(got.columns[:-1]) == schemas.TRAFFIC_COLUMNS
    want = window_sums.with_names(window_sums.traffic_window(records, visitors, jumps, tz="UTC"), names, areas)
    columns = [c for c in schemas.TRAFFIC_COLUMNS if c != "ts"]
    expected = sorted(map(tuple, want.where("stt < '2090-01-01'").select(*columns).collect()), key=str)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == expected
    assert {r.sourceName for r in got.collect()} == {"web"} and {r.provinceName for r in got.collect()} == {None}

    done(jobs.keyword_counts(topic(spark, src), out, cp, tz="UTC"))
    counts = spark.read.parquet(f"{out}/{jobs.KEYWORD_COUNTS}")
    totals = {r.keyword: r.n for r in counts.groupBy("keyword").agg({"keyword_count": "sum"}).toDF("keyword", "n").collect()}
    searched = sum(1 for batch in page_batches(5) for r in batch if "item" in r["page"]) - 1
    assert totals == {"spark": 2 * searched, "流处": searched, "处理": searched}


def test_play_job(spark, tmp_path):
    src, out, cp = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "cp")
    rng = random.Random(2)
    rows = [streams.log_row("a", BASE + i * 1_500 + rng.randrange(1_000), sid=f"s{rng.randrange(3)}",
                            appVideo={"play_sec": i, "video_id": "v", "position_sec": rng.randrange(100)}) for i in range(90)]
    streams.write_files(src, [rows[:30], rows[30:60], rows[60:], [streams.log_row("flush", streams.FAR, appVideo={"play_sec": 0})]])
    done(jobs.play_sessions(topic(spark, src), out, cp))
    got = sorted((r["sessionId"], r["ts"], r["playSec"], r["positionSec"]) for r in lines(spark, f"{out}/{jobs.PLAYS}"))
    plays = logs.flatten_play(parse.drop_bad(sources.raw_topic(spark, src, stream=False)))
    want = learn.play_sessions(plays).where("sessionId is not null").select("sessionId", "ts", "playSec", "positionSec")
    assert got == sorted(map(tuple, want.collect())) and got


def change(table, kind, ts, **data):
    return {"database": "edu", "table": table, "type": kind, "data": data, "ts": str(ts)}


def test_trade_and_user_layer(spark, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    db, log = str(tmp_path / "db"), str(tmp_path / "log")
    created = {"create_time": "2023-11-14 22:13:20"}
    far = [change(t, k, streams.FAR, id="far", order_id="far", payment_status="1602") for t, k in
           (("order_detail", "insert"), ("order_info", "insert"), ("payment_info", "update"), ("user_info", "insert"))]
    streams.write_files(db, [
        [change("order_detail", "insert", BASE, id="d1", order_id="o1", course_id="c", **created),
         change("order_info", "insert", BASE + 500, id="o1", session_id="s1", province_id="7", trade_body="b")],
        [change("order_detail", "insert", BASE + 1_000, id="d2", order_id="o1", **created),
         change("order_detail", "insert", BASE, id="d3", order_id="o2", **created),
         change("order_info", "insert", BASE + 60_000, id="o2", session_id="s1"),
         change("user_info", "insert", BASE + 100, id="u1", **created),
         change("user_info", "insert", BASE + 100, id="u2", **created)],
        [change("payment_info", "update", BASE + 900_000, order_id="o1", payment_status="1602", alipay_trade_no="a"),
         change("payment_info", "insert", BASE + 900_000, order_id="o2", payment_status="1601")],
        far, far])
    streams.write_files(log, [
        [streams.log_row("m1", BASE + 200, page="order", sid="s1", uid="u1"),
         streams.log_row("m2", BASE + 300, page="x", sid="s1")],
        [streams.log_row("m9", BASE + 3_600_000, page="order", sid="s1", uid="u1")],
        [streams.log_row("flush", streams.FAR, uid="far", page="order", sid="far")]])
    done(jobs.order_detail(topic(spark, db), topic(spark, log), out, cp))
    table = sinks.read_upserted(spark, f"{out}/{jobs.ORDER_DETAIL}", "id", "row_op_ts").where("id <> 'far'")
    rows = {r.id: r for r in table.collect()}
    # o2's order came a minute after its line: beyond the limit.
    assert set(rows) == {"d1", "d2"}
    assert (rows["d1"].source_id, rows["d1"].province_id, rows["d1"].date_id) == ("2", "7", "2023-11-14")
    # The batch form without a limit keeps all three.
    events = parse.drop_bad(sources.raw_topic(spark, db, stream=False), schemas.CHANGE, schemas.CHANGE)
    pages = parse.drop_bad(sources.raw_topic(spark, log, stream=False), typed=schemas.PAGE)
    batch = trade.order_detail(trade.detail_slice(events), trade.order_slice(events), trade.order_pages(pages))
    assert {r.id for r in batch.collect()} == {"d1", "d2", "d3", "far"}
    # With the limit it equals the stream.
    timed = events.withColumn("row_time", timefns.F.timestamp_millis(timefns.F.col("ts").cast("bigint")))
    limited = trade.order_detail(trade.detail_slice(timed, "row_time"), trade.order_slice(timed, "row_time"),
                                 trade.order_pages(timefns.with_event_time(pages), "row_time"), "10 seconds")
    columns = list(schemas.ORDER_DETAIL_COLUMNS)
    assert sorted(map(tuple, limited.where("id <> 'far'").select(*columns).collect()), key=str) == sorted(
        map(tuple, table.select(*columns).collect()), key=str)

    details = spark.readStream.schema(spark.read.parquet(f"{out}/{jobs.ORDER_DETAIL}").schema).parquet(
        f"{out}/{jobs.ORDER_DETAIL}").drop("batch")
    done(jobs.pay_success(topic(spark, db), details, out, cp))
    paid = sinks.read_upserted(spark, f"{out}/{jobs.PAY_SUCCESS}", "id", "row_op_ts").where("id <> 'far'")
    assert sorted((r.id, r.alipay_trade_no, r.payment_status) for r in paid.collect()) == [
        ("d1", "a", "1602"), ("d2", "a", "1602")]

    done(jobs.register(topic(spark, db), topic(spark, log), out, cp))
    users = sinks.read_upserted(spark, f"{out}/{jobs.REGISTRATIONS}", "user_id", "row_op_ts").where("user_id <> 'far'")
    assert sorted((r.user_id, r.mid_id, r.register_date) for r in users.collect()) == [
        ("u1", "m1", "2023-11-14"), ("u2", None, "2023-11-14")]
    slices = user.register(user.user_slice(timed, "row_time"), user.login_dims(timefns.with_event_time(pages), None, "row_time"),
                           "10 seconds").where("user_id <> 'far'")
    assert sorted(map(tuple, slices.collect()), key=str) == sorted(
        map(tuple, users.select(*schemas.REGISTER_COLUMNS).collect()), key=str)


def test_routing_jobs(spark, tmp_path):
    db, out, cp = str(tmp_path / "db"), str(tmp_path / "out"), str(tmp_path / "cp")
    streams.write_files(db, [
        [change("order_info", "insert", 1, id="1", user_id="7", note="x"), change("order_info", "update", 2, id="1"),
         change("base_source", "bootstrap-insert", 3, id="1", source_site="web", extra="no")],
        [change("base_source", "update", 5, id="1", source_site=None, url="u"),
         change("base_source", "insert", 6, id="2", source_site="app", url="v"),
         change("base_source", "bootstrap-start", 6, id="9")],
        [change("base_source", "delete", 8, id="2", source_site="app")]])
    loads = []

    def detail_rules():
        loads.append(1)
        rows = [("order_info", "insert", "dwd_order_info", "id,user_id")]
        return spark.createDataFrame(rows, schemas.DETAIL_RULE)

    done(jobs.route_changes(topic(spark, db), detail_rules, f"{out}/detail", cp))
    assert lines(spark, f"{out}/detail/sink_table=dwd_order_info") == [{"id": "1", "user_id": "7", "ts": "1"}]
    assert len(loads) == 3

    rule = ("base_source", "DIM_BASE_SOURCE", "id,source_site,url", None, None)
    for deletes, expected in ((False, [("1", "web", "u"), ("2", "app", "v")]), (True, [("1", "web", "u")])):
        root = f"{out}/dims-{deletes}"
        done(jobs.sink_dims(topic(spark, db), lambda: spark.createDataFrame([rule], schemas.DIM_RULE), root,
                            f"{cp}/{deletes}", apply_deletes=deletes))
        table = dim.read_dim(spark, root, "DIM_BASE_SOURCE", rule[2])
        assert table.columns == ["id", "source_site", "url"]
        assert sorted(map(tuple, table.collect())) == expected


def test_table_jobs_are_strict_and_know_the_unit_of_time(spark, tmp_path):
    created = {"create_time": "2023-11-14 22:13:20"}
    seconds = BASE // 1000

    def events(ts):
        return [change("order_detail", "insert", ts, id="d1", order_id="o1", **created),
                change("order_info", "insert", ts, id="o1", session_id="s1")]

    db, log = str(tmp_path / "db"), str(tmp_path / "log")
    far = [change(t, "insert", streams.FAR // 1000, id="far", order_id="far") for t in ("order_detail", "order_info")]
    streams.write_files(db, [[*events(seconds), "{broken"], far, far])
    streams.write_files(log, [[streams.log_row("m1", BASE + 200, page="order", sid="s1", uid="u1")],
                              [streams.log_row("flush", streams.FAR, uid="far", page="order", sid="far")]])
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        done(jobs.order_detail(topic(spark, db), topic(spark, log), out, str(tmp_path / "cp1"), ts_unit="s"))
    done(jobs.order_detail(topic(spark, db), topic(spark, log), out, str(tmp_path / "cp2"), ts_unit="s", strict=False))
    rows = {r.id: r for r in sinks.read_upserted(spark, f"{out}/{jobs.ORDER_DETAIL}", "id", "row_op_ts").collect()}
    assert rows["d1"].source_id == "2"  # log times are milliseconds, and the two meet
    with pytest.raises(ValueError, match="ts_unit"):
        jobs.order_detail(topic(spark, db), topic(spark, log), out, str(tmp_path / "cp3"), ts_unit="m")


def test_a_quiet_topic_and_a_dimension_that_changes_between_batches(spark, tmp_path):
    """One watermark over the union: no visitor ever comes, and windows close all the same. Names are those of the batch."""
    src, root, out, cp = (str(tmp_path / name) for name in ("src", "dims", "out", "cp"))
    quiet = tmp_path / "quiet"
    quiet.mkdir()
    rule = {"source_table": "base_source", "sink_table": "DIM_BASE_SOURCE", "sink_columns": "ID,SOURCE_SITE", "sink_pk": "ID"}

    def name_source(number, name):
        rows = spark.createDataFrame([("DIM_BASE_SOURCE", str(number), {"ID": "2", "SOURCE_SITE": name})],
                                     "sink_table string, ts string, data map<string,string>")
        dim.upsert_dims(rows, number, root, [rule])

    areas = spark.createDataFrame([("1", "north")], "ID string, NAME string")

    def run(files):
        streams.write_files(src, files)
        done(jobs.traffic_sums(topic(spark, src), topic(spark, str(quiet)), topic(spark, str(quiet)),
                               lambda: dim.read_dim(spark, root, "DIM_BASE_SOURCE", "ID,SOURCE_SITE", "ID"), areas, out, cp, tz="UTC"))
        rows = spark.read.parquet(f"{out}/{jobs.TRAFFIC_SUMS}").collect()
        return sorted((r.stt, r.sourceName, r.provinceName, r.pageViewCount) for r in rows)

    files = [[streams.log_row("m", 1_700_000_000_000 + minute * 60_000)] for minute in range(4)]
    name_source(1, "first name")
    seen = run(files[:2])
    assert seen and {r[1:3] for r in seen} == {("first name", "north")}
    name_source(2, "second name")
    later = run(files)
    assert later[:len(seen)] == seen and {r[1] for r in later[len(seen):]} == {"second name"}
