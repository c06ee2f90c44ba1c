"""Plans: what must and must not be in them at any size of the input."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidehouse import schemas, sources
from tidehouse.operators import cells, dim, logs, trade, traffic, window_sums
from tidehouse.plans import catalog

BATCH = sorted(name for name in catalog.QUERIES if not name.startswith("stream_"))


def plan(df, mode="executedPlan"):
    return getattr(df._jdf.queryExecution(), mode)().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(catalog.QUERIES[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "SinglePartition"):
        assert operator not in text, operator


@pytest.mark.parametrize("name", ["unique_visitors", "latest_by_key", "rules_folded", "cells_scan", "order_detail_table"])
def test_ranking_is_limited_before_the_shuffle(spark, folder, name):
    text = plan(catalog.QUERIES[name](spark, folder))
    assert re.search(r"WindowGroupLimit.*Partial", text)


@pytest.mark.parametrize("name", ["route_detail", "route_dim"])
def test_routing_does_not_shuffle_events(spark, folder, name):
    text = plan(catalog.QUERIES[name](spark, folder))
    assert "BuildRight" in text and "Exchange hashpartitioning" not in text


def pages(spark, folder):
    return catalog.topics.page_log(spark, folder)


def test_jumps_shuffle_once(spark, folder):
    text = plan(traffic.user_jumps(pages(spark, folder)))
    assert text.count("Exchange hashpartitioning") == 1 and "common#" in text


def test_first_days_combine_before_the_shuffle(spark, folder):
    text = plan(logs.first_days(pages(spark, folder)))
    assert text.count("HashAggregate") == 2 and "partial_min" in text


def test_traffic_window_reads_only_what_it_needs(spark, folder, tmp_path):
    path = str(tmp_path / "pages")
    pages(spark, folder).write.parquet(path)
    stored = spark.read.parquet(path)
    text = plan(window_sums.traffic_window(stored, stored.where("false"), stored.where("false")))
    assert "partial_sum" in text
    assert "ReadSchema: struct<common:struct<is_new:string,ar:string,sc:string,vc:string>,page:struct<last_page_id" in text
    assert "page_id:" not in text.replace("last_page_id:", "") and "item" not in text


def test_filters_reach_a_stored_page_log(spark, folder, tmp_path):
    path = str(tmp_path / "pages")
    pages(spark, folder).write.parquet(path)
    stored = sources.table(spark, path, "parquet")
    text = plan(logs.page_slice(stored, "order").select("common.sid", "common.sc"))
    assert "EqualTo(page.page_id,order)" in text
    assert re.search(r"ReadSchema: struct<common:struct<sid:string,sc:string>,page:struct<page_id:string>>", text)


def test_change_slices_skip_other_tables(spark, folder):
    text = plan(catalog.QUERIES["cdc_paid_slice"](spark, folder))
    assert "orders.parquet" in text and "lineitem.parquet" not in text and "customer.parquet" not in text


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}
HOT_ROWS = 20_000


@pytest.fixture
def small_skew(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_table(spark, path):
    """Rows of which one key has a third; every row is different, so that nothing compresses away."""
    rng = random.Random(3)
    rows = [(n, "hot" if rng.random() < 0.34 else f"k{rng.randrange(3000)}", rng.choice("01")) for n in range(HOT_ROWS)]
    spark.createDataFrame(rows, "n bigint, key string, flag string").repartition(8).withColumn(
        "noise", F.sha2(F.concat("key", F.col("n").cast("string")), 512)).write.parquet(path)
    return spark.read.parquet(path)


def is_split(df):
    df.collect()
    return "skew=true" in plan(df)


def test_hot_device_is_split(spark, tmp_path, small_skew):
    rows = hot_table(spark, str(tmp_path / "t")).select(
        F.struct(F.col("key").alias("mid"), F.col("flag").alias("is_new")).alias("common"),
        (F.col("n") * 1000).alias("ts"), "noise")
    df = logs.repair_is_new(rows, "UTC").select("common.mid", "common.is_new", "noise")
    assert is_split(df) and df.count() == HOT_ROWS


def test_hot_order_and_session_are_split(spark, tmp_path, small_skew):
    table = hot_table(spark, str(tmp_path / "t"))
    columns = ["user_id", "course_id", "create_time", "origin_amount", "coupon_reduce", "final_amount", "date_id"]
    lines = table.select(F.col("n").cast("string").alias("id"), F.col("key").alias("order_id"),
                         *[F.col("noise").alias(c) for c in columns], F.lit("1").alias("ts"))
    keys = table.select("key").distinct()
    orders = keys.select(F.col("key").alias("id"), F.lit("7").alias("province_id"), F.lit("t").alias("out_trade_no"),
                         F.col("key").alias("session_id"), F.lit("b").alias("trade_body"), F.lit("1").alias("order_ts"))
    sessions = keys.select(F.col("key").alias("page_session"), F.lit("s").alias("source_id"), F.lit(1).alias("page_ts"))
    details = trade.order_detail(lines, orders, sessions)
    assert is_split(details) and details.count() == HOT_ROWS
    # One session with a third of all orders.
    many = table.select(F.col("n").cast("string").alias("id"), F.lit("7").alias("province_id"), F.col("noise").alias("out_trade_no"),
                        F.col("key").alias("session_id"), F.lit("b").alias("trade_body"), F.lit("1").alias("order_ts"))
    assert is_split(trade.order_detail(lines.withColumn("order_id", F.col("id")), many, sessions))

    payments = keys.select(*[F.lit(c).alias(c) for c in ("alipay_trade_no", "trade_body", "payment_type", "payment_status",
                                                        "callback_time", "callback_content")],
                           F.col("key").alias("order_id"), F.lit("1").alias("ts"))
    paid = trade.pay_success(payments, lines.withColumnRenamed(
        "coupon_reduce", "coupon_reduce_amount").withColumns({c: F.lit("x") for c in ("province_id", "session_id")}))
    assert is_split(paid) and paid.count() == HOT_ROWS


def test_hot_dimension_key_is_split_when_the_dimension_is_big(spark, tmp_path, small_skew):
    table = hot_table(spark, str(tmp_path / "t"))
    names = table.select(F.col("key").alias("ID"), F.col("key").alias("NAME"))
    df = dim.enrich(table, names, {"key": "ID"}, {"name": "NAME"}, limit_bytes=0)
    assert is_split(df) and df.where("name = key").count() == HOT_ROWS


def test_row_with_many_cells_is_split(spark, tmp_path, small_skew):
    table = hot_table(spark, str(tmp_path / "t"))
    made = cells.put(table.select(F.col("key").alias("row"), F.lit("f").alias("family"),
                                  F.col("n").cast("string").alias("qualifier"), F.col("noise").alias("value")), F.lit(5))
    gone = cells.delete(table.where("key <> 'hot'").select(F.col("key").alias("row"), F.lit("f").alias("family")), at_ms=F.lit(1))
    df = cells.latest(made.unionByName(gone))
    assert is_split(df) and df.count() == HOT_ROWS


def test_play_sessions_merge_few_rows(spark):
    """The second shuffle of a hot session id carries sessions, not rows."""
    from tidehouse.operators import learn
    values = ", ".join(f"{n} {'int' if n.endswith('Sec') else 'bigint' if n == 'ts' else 'string'}" for n in schemas.PLAY_COLUMNS)
    rows = [("s", "p", "u", "o", "c", "0", "m", "mid", "v", "b", "hot", 1, n, "v1", 1_700_000_000_000 + n) for n in range(5000)]
    df = learn.play_sessions(spark.createDataFrame(rows, values))
    assert plan(df).count("Exchange hashpartitioning") == 2
    row, = df.collect()
    assert (row.playSec, row.positionSec) == (5000, 4999)


def test_first_logins_of_a_hot_device(spark, tmp_path):
    """No array of a device's rows anywhere, joins on unique (device, time), and the right chain for a device that is always on."""
    from tidehouse.operators import user
    rng = random.Random(8)
    day = 86_400_000
    times = sorted(rng.randrange(70 * day) for _ in range(15_000))
    rows = [("hot", t) for t in times] + [(f"k{n % 900}", rng.randrange(70 * day)) for n in range(5_000)]
    df = spark.createDataFrame([(m, "u", t) for m, t in rows * 2], "mid string, uid string, ts bigint").select(
        F.struct("mid", "uid").alias("common"), F.struct(F.lit("p").alias("page_id")).alias("page"), "ts")
    opened = user.first_login(df.repartition(6))
    text = plan(opened) + plan(user._following(df.select(F.col("common.mid").alias("_key"), F.col("ts").alias("_ts")), day, day // 24))
    assert "collect_list" not in text and "collect_set" not in text and "InArrow" not in text
    want, last = [], -day
    for t in times:
        if t >= last + day:
            want.append(t)
            last = t
    assert sorted(r.ts for r in opened.where("common.mid = 'hot'").collect()) == want
