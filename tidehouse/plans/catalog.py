"""The registered queries, each with equivalent SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidehouse import schemas, session, sinks, sources
from tidehouse.functions import textfns, timefns
from tidehouse.operators import cdc, cells, changelog, config, dim, keywords, learn, logs, parse, trade, traffic, user
from tidehouse.operators import window_sums
from tidehouse.plans import jobs, topics_from_tables as topics
from tidehouse.plans.topics_from_tables import CELLS_SQL, CHANGES_SQL, PAGE_LOG_SQL, RAW_LOG_SQL, SESSIONS_SQL, stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

UTC = "UTC"


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = sql
        return function
    return register


# ================================================================ site log: filters

_VIEW = "SELECT mid, page_id, ts, event_id FROM page_log "


def _view(df: DataFrame) -> DataFrame:
    return df.select("common.mid", "page.page_id", "ts", "event_id")


@query(f"WITH {PAGE_LOG_SQL} {_VIEW} WHERE last_page_id IS NULL")
def session_starts(spark, folder):
    return _view(logs.session_starts(topics.page_log(spark, folder)))


@query(f"WITH {PAGE_LOG_SQL} {_VIEW} WHERE uid IS NOT NULL")
def logged_in_pages(spark, folder):
    return _view(logs.page_slice(topics.page_log(spark, folder), logged_in=True))


@query(f"WITH {PAGE_LOG_SQL} {_VIEW} WHERE page_id = 'order'")
def page_slice(spark, folder):
    return _view(logs.page_slice(topics.page_log(spark, folder), "order"))


@query(f"""WITH {PAGE_LOG_SQL} SELECT CAST(k AS VARCHAR) AS full_word, ts // 1000 AS second
       FROM page_log WHERE event_type = 'view'""")
def search_terms(spark, folder):
    return logs.search_terms(topics.page_log(spark, folder)).select(
        "full_word", F.unix_seconds("row_time").alias("second"))


@query(f"""WITH {PAGE_LOG_SQL} SELECT uid AS "userId", day AS "dateId",
       strftime(make_timestamp(ts * 1000), '%Y-%m-%d %H:%M:%S') AS "loginTime", sc AS "sourceId", 'web' AS channel,
       ar AS "provinceId", vc AS "versionCode", mid AS "midId", 'brand' AS brand, 'model' AS model,
       'os' AS "operatingSystem", ts FROM page_log""")
def login_rows(spark, folder):
    return logs.flatten_login(topics.page_log(spark, folder), UTC)


# ================================================================ site log: parsing and split

@query("""SELECT '{"mid":"' || user_id || '","ts":' || (epoch_us(ts) // 1000) AS value, event_id FROM events
       WHERE event_type = 'view' AND value < 5""")
def dirty_rows(spark, folder):
    return parse.split_dirty(topics.raw_log(spark, folder))[1].select("value", "event_id")


@query(f"""WITH {RAW_LOG_SQL} SELECT event_id, mid, uid, sid, is_new, ar, sc, vc, page_id, last_page_id,
       during_time, ts FROM log""")
def parsed_log(spark, folder):
    return parse.drop_bad(topics.raw_log(spark, folder)).select(
        "event_id", "common.mid", "common.uid", "common.sid", "common.is_new", "common.ar", "common.sc", "common.vc",
        "page.page_id", "page.last_page_id", "page.during_time", "ts")


def _split(spark, folder) -> dict[str, DataFrame]:
    return logs.split_log(parse.drop_bad(topics.raw_log(spark, folder), record=parse.RECORD))


_STARTED = "(event_type = 'signup' OR (event_type = 'error' AND k < 30))"


@query(f"""WITH {RAW_LOG_SQL} SELECT mid, ts, '{{"code":' || k || '}}' AS err FROM log WHERE event_type = 'error'""")
def log_split_error(spark, folder):
    return _split(spark, folder)["error"].select("common.mid", "ts", "err")


@query(f"""WITH {RAW_LOG_SQL} SELECT mid, ts, '{{"entry":"icon","k":' || k || '}}' AS start FROM log
       WHERE {_STARTED}""")
def log_split_start(spark, folder):
    return _split(spark, folder)["start"].select("common.mid", "ts", "start")


@query(f"""WITH {RAW_LOG_SQL} SELECT sc AS "sourceId", ar AS "provinceId", uid AS "userId", 'os' AS "operatingSystem",
       'web' AS channel, is_new AS "isNew", 'model' AS model, mid AS "machineId", vc AS "versionCode",
       'brand' AS brand, sid AS "sessionId", k AS "playSec", CAST(floor(value) AS INTEGER) AS "positionSec",
       'v' || k AS "videoId", ts FROM log WHERE event_type = 'click'""")
def log_split_video(spark, folder):
    return logs.flatten_play(_split(spark, folder)["video"])


@query(f"""WITH {RAW_LOG_SQL} SELECT mid, page_id, ts, '{{"item":' || i || '}}' AS display
       FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM log WHERE event_type = 'view')""")
def log_split_display(spark, folder):
    return _split(spark, folder)["display"].select("common.mid", "page.page_id", "ts", "display")


@query(f"""WITH {RAW_LOG_SQL} SELECT mid, page_id, '{{"act":' || i || '}}' AS action
       FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM log WHERE event_type = 'purchase')""")
def log_split_action(spark, folder):
    return _split(spark, folder)["action"].select("common.mid", "page.page_id", "action")


@query(f"""WITH {RAW_LOG_SQL} SELECT mid, page_id, last_page_id, during_time, ts, event_id FROM log
       WHERE event_type <> 'click' AND NOT {_STARTED}""")
def log_split_page(spark, folder):
    return _split(spark, folder)["page"].select(
        "common.mid", "page.page_id", "page.last_page_id", "page.during_time", "ts", "event_id")


@query(f"""WITH {RAW_LOG_SQL}, outputs AS (
       SELECT 'error' AS output, mid FROM log WHERE event_type = 'error'
       UNION ALL SELECT 'start', mid FROM log WHERE {_STARTED}
       UNION ALL SELECT 'video', mid FROM log WHERE event_type = 'click'
       UNION ALL SELECT 'page', mid FROM log WHERE event_type <> 'click' AND NOT {_STARTED}
       UNION ALL SELECT 'display', mid FROM (SELECT mid, unnest(range(1, k % 3 + 1)) FROM log WHERE event_type = 'view')
       UNION ALL SELECT 'action', mid FROM (
         SELECT mid, unnest(range(1, k % 4 + 1)) FROM log WHERE event_type = 'purchase'))
       SELECT output, mid, count(*) AS records FROM outputs GROUP BY ALL""")
def log_split_one_pass(spark, folder):
    tagged = logs.split_tagged(parse.drop_bad(topics.raw_log(spark, folder), record=parse.RECORD))
    return tagged.groupBy("output", F.get_json_object("value", "$.common.mid").alias("mid")).agg(
        F.count(F.lit(1)).alias("records"))


_COMMON_TEXT = """'"common":{"ar":"' || ar || '","ba":"brand","ch":"web","ip":"10.0.0.' || CAST(mid AS BIGINT) % 250 ||
       '","is_new":"' || is_new || '","md":"model","mid":"' || mid || '","os":"os","sc":"' || sc || '","sid":"' || sid ||
       CASE WHEN uid IS NULL THEN '' ELSE '","uid":"' || uid END || '","vc":"' || vc || '"}'"""
_PAGE_TEXT = """'"page":{"during_time":' || during_time ||
       CASE WHEN event_type = 'error' THEN '' ELSE ',"item":"' || k || '"' END || ',"item_type":"' ||
       CASE WHEN event_type = 'view' THEN 'keyword' ELSE 'course' END || '"' ||
       CASE WHEN last_page_id IS NULL THEN '' ELSE ',"last_page_id":"' || last_page_id || '"' END ||
       ',"page_id":"' || page_id || '","refer_id":' || k || '}'"""


@query(f"""WITH {RAW_LOG_SQL}, texts AS (
       SELECT *, {_COMMON_TEXT} AS c, {_PAGE_TEXT} AS p, '"ts":' || ts AS t,
              ',"trace":{{"hop":"9","id":' || event_id || '}}}}' AS tail,
              CASE WHEN {_STARTED} THEN ',"start":{{"entry":"icon","k":' || k || '}}' ELSE '' END AS s,
              '{{"play_sec":' || k || ',"position_sec":' || CAST(floor(value) AS INTEGER) || ',"video_id":"v' || k || '"}}' AS v
       FROM log)
       SELECT 'error' AS output, '{{' || c || ',' || p || s || ',"err":{{"code":' || k || '}},' || t || tail AS value
       FROM texts WHERE event_type = 'error'
       UNION ALL SELECT 'start', '{{' || c || ',' || p || s || ',' || t || tail FROM texts WHERE {_STARTED}
       UNION ALL SELECT 'video', '{{' || c || ',' || p || ',"appVideo":' || v || ',' || t || tail FROM texts
       WHERE event_type = 'click'
       UNION ALL SELECT 'page', '{{' || c || ',' || p || ',' || t || tail FROM texts
       WHERE event_type <> 'click' AND NOT {_STARTED}
       UNION ALL SELECT 'display', '{{"display":{{"item":' || i || '}},' || c || ',' || p || ',' || t || '}}'
       FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM texts WHERE event_type = 'view')
       UNION ALL SELECT 'action', '{{"action":{{"act":' || i || '}},' || c || ',' || p || '}}'
       FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM texts WHERE event_type = 'purchase')""")
def log_split_records(spark, folder):
    """The whole text of every output, with the members that the schema does not declare."""
    return logs.split_tagged(parse.drop_bad(topics.raw_log(spark, folder), record=parse.RECORD))


@query(f"""WITH {PAGE_LOG_SQL}, firsts AS (
       SELECT mid, arg_min(CASE WHEN is_new = '1' THEN day
                                ELSE strftime(make_timestamp(ts * 1000) - INTERVAL 1 DAY, '%Y-%m-%d') END,
                           (ts, 1 - CAST(is_new AS INTEGER))) AS first_day FROM page_log GROUP BY mid)
       SELECT p.mid, p.ts, p.event_id,
              CASE WHEN is_new = '1' AND day <> first_day THEN '0' ELSE is_new END AS is_new
       FROM page_log p JOIN firsts f ON p.mid = f.mid""")
def is_new_repair(spark, folder):
    return logs.repair_is_new(topics.page_log(spark, folder), UTC).select(
        "common.mid", "ts", "event_id", "common.is_new")


# ================================================================ traffic

_UV = """uv AS (SELECT * FROM page_log WHERE last_page_id IS NULL
       QUALIFY row_number() OVER (PARTITION BY mid, day ORDER BY ts, event_id) = 1)"""
_JUMP = """jump AS (SELECT * FROM (
         SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id IS NULL) OVER w AS next_start FROM page_log
         WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
       WHERE last_page_id IS NULL AND (next_ts IS NULL OR next_ts - ts >= 21600000 OR next_start))"""


@query(f"WITH {PAGE_LOG_SQL}, {_UV} SELECT mid, page_id, ts, event_id FROM uv")
def unique_visitors(spark, folder):
    return _view(traffic.unique_visitors(topics.page_log(spark, folder), UTC, ["event_id"]))


@query(f"WITH {PAGE_LOG_SQL}, {_JUMP} SELECT mid, page_id, ts, event_id FROM jump")
def user_jumps(spark, folder):
    return _view(traffic.user_jumps(topics.page_log(spark, folder), "6 hours", ["event_id"]))


_TRAFFIC = f"""WITH {PAGE_LOG_SQL}, {_UV}, {_JUMP}, rows AS (
       SELECT ts, vc, sc, ar, is_new, 0 AS uv, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS ss, 1 AS pv,
              during_time AS dur, 0 AS jp FROM page_log
       UNION ALL SELECT ts, vc, sc, ar, is_new, 1, 0, 0, 0, 0 FROM uv
       UNION ALL SELECT ts, vc, sc, ar, is_new, 0, 0, 0, 0, 1 FROM jump),
       sums AS (
       SELECT strftime(make_timestamp((ts // 3600000) * 3600000000), '%Y-%m-%d %H:%M:%S') AS stt,
              strftime(make_timestamp((ts // 3600000 + 1) * 3600000000), '%Y-%m-%d %H:%M:%S') AS edt,
              vc AS "versionCode", sc AS "sourceId", ar, is_new AS "isNew", CAST(sum(uv) AS BIGINT) AS "uvCount",
              CAST(sum(ss) AS BIGINT) AS "totalSessionCount", CAST(sum(pv) AS BIGINT) AS "pageViewCount",
              CAST(sum(dur) AS BIGINT) AS "totalDuringTime", CAST(sum(jp) AS BIGINT) AS "jumpSessionCount"
       FROM rows GROUP BY ALL)"""


@query(f"{_TRAFFIC} SELECT * FROM sums")
def traffic_window(spark, folder):
    pages = topics.page_log(spark, folder)
    visitors = traffic.unique_visitors(pages, UTC, ["event_id"])
    jumps = traffic.user_jumps(pages, "6 hours", ["event_id"])
    return window_sums.traffic_window(pages, visitors, jumps, "1 hour", tz=UTC, emit_time=False)


@query(f"""{_TRAFFIC} SELECT sums.*, r_name AS "sourceName", n_name AS "provinceName" FROM sums
       LEFT JOIN region ON "sourceId" = CAST(r_regionkey AS VARCHAR)
       LEFT JOIN nation ON ar = CAST(n_nationkey AS VARCHAR)""")
def traffic_window_enriched(spark, folder):
    sources = stored(spark, folder, "region").select(
        F.col("r_regionkey").cast("string").alias("ID"), F.col("r_name").alias("SOURCE_SITE"))
    provinces = stored(spark, folder, "nation").select(
        F.col("n_nationkey").cast("string").alias("ID"), F.col("n_name").alias("NAME"))
    return window_sums.with_names(traffic_window(spark, folder), sources, provinces)


@query(f"""WITH {PAGE_LOG_SQL} SELECT sc AS "sourceId", vc AS "versionCode", ar, is_new AS "isNew",
       CAST(0 AS BIGINT) AS "uvCount",
       CAST(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS "totalSessionCount",
       CAST(1 AS BIGINT) AS "pageViewCount", during_time AS "totalDuringTime", CAST(0 AS BIGINT) AS "jumpSessionCount",
       ts FROM page_log""")
def page_metrics(spark, folder):
    return window_sums.page_metrics(topics.page_log(spark, folder))


# ================================================================ users

_LOGINS = f"""WITH RECURSIVE {PAGE_LOG_SQL}, logins AS (SELECT * FROM page_log WHERE uid IS NOT NULL),
       episodes AS (
         SELECT mid, min(ts) AS ts FROM logins GROUP BY mid
         UNION ALL
         SELECT e.mid, min(l.ts) FROM episodes e JOIN logins l ON l.mid = e.mid AND l.ts >= e.ts + 86400000
         GROUP BY e.mid, e.ts)
       SELECT l.mid, l.ts, l.event_id FROM logins l JOIN episodes e ON l.mid = e.mid AND l.ts = e.ts
       QUALIFY row_number() OVER (PARTITION BY l.mid, l.ts ORDER BY event_id) = 1"""


@query(_LOGINS)
def first_login(spark, folder):
    return user.first_login(topics.page_log(spark, folder), tie=["event_id"]).select("common.mid", "ts", "event_id")


@query(_LOGINS)
def first_login_coarse_slots(spark, folder):
    """Slots of a third of the period."""
    return user.first_login(topics.page_log(spark, folder), tie=["event_id"], slots_per_hold=3).select(
        "common.mid", "ts", "event_id")


_REGISTER = f"""WITH {PAGE_LOG_SQL}, {CHANGES_SQL},
       dims AS (SELECT * FROM page_log WHERE uid IS NOT NULL
                QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, vc DESC) = 1)
       SELECT u.id AS user_id, u.create_time AS register_time, u.create_date AS register_date,
              CASE WHEN d.uid IS NOT NULL THEN 'web' END AS channel, d.ar AS province_id, d.vc AS version_code,
              d.sc AS source_id, d.mid AS mid_id, CASE WHEN d.uid IS NOT NULL THEN 'brand' END AS brand,
              CASE WHEN d.uid IS NOT NULL THEN 'model' END AS model,
              CASE WHEN d.uid IS NOT NULL THEN 'os' END AS operate_system, u.ts
       FROM user_info u LEFT JOIN dims d ON u.id = d.uid WHERE u.type = 'insert'"""


@query(_REGISTER)
def register_wide(spark, folder):
    users = user.user_slice(topics.change_log(spark, folder))
    return user.register(users, user.login_dims(topics.page_log(spark, folder)))


# ================================================================ play sessions

_PLAYS = f"""WITH {PAGE_LOG_SQL}, plays AS (
       SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN k END AS k) FROM page_log),
       marked AS (
       SELECT *, CASE WHEN ts - lag(ts) OVER w <= 7200000 THEN 0 ELSE 1 END AS opens FROM plays
       WINDOW w AS (PARTITION BY sid ORDER BY ts, event_id)),
       numbered AS (SELECT *, sum(opens) OVER (PARTITION BY sid ORDER BY ts, event_id) AS n FROM marked)
       SELECT arg_min(sc, (ts, event_id)) AS "sourceId", arg_min(ar, (ts, event_id)) AS "provinceId",
              arg_min(mid, (ts, event_id)) AS "userId", 'os' AS "operatingSystem", 'web' AS channel,
              arg_min(is_new, (ts, event_id)) AS "isNew", 'model' AS model, arg_min(mid, (ts, event_id)) AS "machineId",
              arg_min(vc, (ts, event_id)) AS "versionCode", 'brand' AS brand, sid AS "sessionId",
              CAST(sum(k) AS BIGINT) AS "playSec", arg_max(during_time, (ts, event_id)) AS "positionSec",
              nullif(arg_min(coalesce('v' || k, 'none'), (ts, event_id)), 'none') AS "videoId", min(ts) AS ts
       FROM numbered GROUP BY sid, n"""


def _plays(pages: DataFrame) -> DataFrame:
    return logs.flatten_play(pages.select(
        F.col("common").withField("uid", F.col("common.mid")).alias("common"), "ts", "event_id",
        F.struct(F.col("page.item").cast("int").alias("play_sec"),
                 F.concat(F.lit("v"), "page.item").alias("video_id"),
                 F.col("page.during_time").alias("position_sec")).alias("appVideo")), "event_id")


@query(_PLAYS)
def play_sessions(spark, folder):
    return learn.play_sessions(_plays(topics.page_log(spark, folder)), "2 hours", ["event_id"], span=6)


# ================================================================ change events

@query(f"""WITH {CHANGES_SQL} SELECT id, order_id, course_id, create_time, date_id, final_amount, ts
       FROM order_detail""")
def cdc_slice(spark, folder):
    return trade.detail_slice(topics.change_log(spark, folder)).select(
        "id", "order_id", "course_id", "create_time", "date_id", "final_amount", "ts")


@query(f"""WITH {CHANGES_SQL} SELECT order_id, alipay_trade_no, payment_status, callback_time, callback_content, ts
       FROM payment_info WHERE payment_status = '1602'""")
def cdc_paid_slice(spark, folder):
    return trade.payment_slice(topics.change_log(spark, folder)).select(
        "order_id", "alipay_trade_no", "payment_status", "callback_time", "callback_content", "ts")


def _all_changes(where: str) -> str:
    parts = [f"SELECT '{name}' AS \"table\", type FROM {name}"
             for name in ("order_detail", "order_info", "payment_info", "user_info")]
    return f"""WITH {CHANGES_SQL}, changes AS ({' UNION ALL '.join(parts)})
       SELECT "table", type, count(*) AS events FROM changes WHERE {where} GROUP BY ALL"""


def _by_table_and_type(df: DataFrame) -> DataFrame:
    return df.groupBy("table", "type").agg(F.count(F.lit(1)).alias("events"))


@query(_all_changes("type NOT IN ('bootstrap-start', 'bootstrap-complete', 'bootstrap-insert')"))
def cdc_control_filter(spark, folder):
    return _by_table_and_type(cdc.drop_control(topics.change_log(spark, folder)))


@query(_all_changes("type NOT IN ('bootstrap-start', 'bootstrap-complete')"))
def cdc_control_filter_dim(spark, folder):
    return _by_table_and_type(cdc.drop_control(topics.change_log(spark, folder), keep_snapshot_rows=True))


_DETAIL_RULES = [
    ("order_detail", "insert", "dwd_order_detail", "order_id,final_amount"),
    ("order_info", "insert", "dwd_order_info", "id,session_id"),
    ("payment_info", "insert", "dwd_payment", "order_id"),
    ("user_info", "insert", "dwd_user", "id,name"),
]


def _routed(spark, folder, mode: str) -> DataFrame:
    rules = spark.createDataFrame(_DETAIL_RULES, schemas.DETAIL_RULE)
    routed = cdc.route_detail(cdc.drop_control(topics.change_log(spark, folder)), rules, mode)
    names = ("id", "order_id", "final_amount", "session_id", "name")
    return routed.select("sink_table", "ts", *[F.col("data")[name].alias(name) for name in names],
                         F.size("data").alias("width"))


def _routed_sql(detail_id: str, detail_width: int) -> str:
    return f"""WITH {CHANGES_SQL}
       SELECT 'dwd_order_detail' AS sink_table, ts, {detail_id} AS id, order_id, final_amount, NULL AS session_id,
              NULL AS name, {detail_width} AS width FROM order_detail
       UNION ALL SELECT 'dwd_order_info', ts, id, NULL, NULL, session_id, NULL, 2 FROM order_info
       UNION ALL SELECT 'dwd_user', ts, id, NULL, NULL, NULL, name, 2 FROM user_info WHERE type = 'insert'"""


@query(_routed_sql("NULL", 2))
def route_detail(spark, folder):
    return _routed(spark, folder, "exact")


@query(_routed_sql("id", 3))
def route_detail_substring(spark, folder):
    return _routed(spark, folder, "substring")


#: First change of a rule and milliseconds between changes of the query below: 1995-01-01, 90 days.
_FIRST_CHANGE, _CHANGE_STEP = 788_918_400_000, 7_776_000_000


@query(f"""WITH {CHANGES_SQL},
       changes AS (SELECT n_regionkey, n_nationkey, {_FIRST_CHANGE} + (n_nationkey // 2 * 7 % 25) * {_CHANGE_STEP}::BIGINT AS at,
                          n_nationkey % 5 = 4 AS gone FROM nation),
       judged AS (
       SELECT o.ts, o.id, c.* FROM order_info o JOIN changes c ON c.at <= CAST(o.ts AS BIGINT)
       QUALIFY row_number() OVER (PARTITION BY o.id ORDER BY c.at DESC, c.n_nationkey DESC) = 1)
       SELECT 'dwd_' || n_nationkey AS sink_table, ts, CASE WHEN n_nationkey % 2 = 0 THEN id END AS id FROM judged WHERE NOT gone""")
def route_detail_as_of(spark, folder):
    """One rule that changes, and is removed and made again, between the events; two changes fall on one instant."""
    key = F.col("n_nationkey")
    rule = F.struct(F.lit("order_info").alias("source_table"), F.lit("insert").alias("source_type"),
                    F.concat(F.lit("dwd_"), key.cast("string")).alias("sink_table"),
                    F.when(key % 2 == 0, "id,session_id").otherwise("session_id").alias("sink_columns"))
    gone = key % 5 == 4
    at = F.lit(_FIRST_CHANGE) + (F.floor(key / 2).cast("bigint") * 7 % 25) * _CHANGE_STEP
    changes = stored(spark, folder, "nation").select(
        F.when(gone, "d").otherwise("u").alias("op"), F.when(gone, rule).alias("before"), F.when(~gone, rule).alias("after"),
        at.alias("ts_ms"), key.alias("pos"))
    routed = cdc.route_detail_as_of(topics.change_log(spark, folder), config.rule_versions(changes, ["ts_ms", "pos"]))
    return routed.select("sink_table", "ts", F.col("data")["id"].alias("id"))


_DIM_RULES = [
    {"source_table": "user_info", "sink_table": "dim_user_info", "sink_columns": "id,name,nation,segment",
     "sink_pk": "id", "sink_extend": None},
    {"source_table": "order_info", "sink_table": "dim_order_info", "sink_columns": "id,user_id,province_id",
     "sink_pk": None, "sink_extend": None},
]


def _dim_routed(spark, folder) -> DataFrame:
    rules = spark.createDataFrame(_DIM_RULES, schemas.DIM_RULE)
    return cdc.route_dim(cdc.drop_control(topics.change_log(spark, folder), keep_snapshot_rows=True), rules)


@query(f"""WITH {CHANGES_SQL}
       SELECT 'dim_user_info' AS sink_table, 'id' AS sink_pk, type, ts, id, segment, NULL AS user_id, 4 AS width
       FROM user_info WHERE type NOT IN ('bootstrap-start', 'bootstrap-complete')
       UNION ALL SELECT 'dim_order_info', 'id', type, ts, id, NULL, user_id, 3 FROM order_info""")
def route_dim(spark, folder):
    return _dim_routed(spark, folder).select(
        "sink_table", "sink_pk", "type", "ts", *[F.col("data")[name].alias(name) for name in ("id", "segment", "user_id")],
        F.size("data").alias("width"))


@query(f"""WITH {PAGE_LOG_SQL}, latest AS (
         SELECT *, row_number() OVER (PARTITION BY 't' || mid || page_id ORDER BY ts DESC, event_id DESC) AS n
         FROM page_log)
       SELECT 't' || mid || page_id AS source_table, page_id AS source_type, 'dwd_' || mid AS sink_table,
              'c' || k AS sink_columns FROM latest WHERE n = 1 AND k < 90""")
def rules_folded(spark, folder):
    """Rule changes made from the log: one rule per device and page, removed by records with a high counter."""
    pages = topics.stored(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    page = F.when(F.col("event_type") == "purchase", "order").otherwise(F.col("event_type"))
    mid = F.col("user_id").cast("string")
    rule = F.struct(F.concat(F.lit("t"), mid, page).alias("source_table"), page.alias("source_type"),
                    F.concat(F.lit("dwd_"), mid).alias("sink_table"),
                    F.concat(F.lit("c"), F.col("k").cast("string")).alias("sink_columns"))
    removed = F.col("k") >= 90
    changes = pages.select(F.when(removed, "d").otherwise("u").alias("op"), F.when(removed, rule).alias("before"),
                           F.when(~removed, rule).alias("after"), topics.utc_ms("ts").alias("ts_ms"), "event_id")
    return config.fold_changes(changes, ["ts_ms", "event_id"])


# ================================================================ trade

_ORDER_DETAIL = f"""{PAGE_LOG_SQL}, {CHANGES_SQL},
       order_pages AS (SELECT sid, sc FROM page_log WHERE page_id = 'order'
                       QUALIFY row_number() OVER (PARTITION BY sid ORDER BY ts DESC, sc DESC) = 1),
       wide AS (
       SELECT d.id, d.order_id, d.user_id, d.course_id, o.province_id, d.date_id, o.session_id, p.sc AS source_id,
              d.create_time, d.origin_amount, d.coupon_reduce AS coupon_reduce_amount, d.final_amount,
              o.out_trade_no, o.trade_body, d.ts
       FROM order_detail d JOIN order_info o ON d.order_id = o.id LEFT JOIN order_pages p ON o.session_id = p.sid)"""


@query(f"WITH {_ORDER_DETAIL} SELECT * FROM wide")
def order_detail_wide(spark, folder):
    changes = topics.change_log(spark, folder)
    return trade.order_detail(trade.detail_slice(changes), trade.order_slice(changes),
                              trade.order_pages(topics.page_log(spark, folder)))


_LINE_ORDER = ["create_time", "course_id", "user_id", "final_amount"]


@query(f"""WITH {_ORDER_DETAIL} SELECT * FROM wide
       QUALIFY row_number() OVER (PARTITION BY id ORDER BY {', '.join(c + ' DESC' for c in _LINE_ORDER)}) = 1""")
def order_detail_table(spark, folder):
    """The keyed table: the latest row of every line."""
    return changelog.latest_by_key(order_detail_wide(spark, folder), "id", _LINE_ORDER)


@query(f"""WITH {_ORDER_DETAIL}
       SELECT w.id, w.order_id, w.user_id, w.course_id, w.province_id, w.date_id, p.alipay_trade_no, p.trade_body,
              p.payment_type, p.payment_status, p.callback_time, p.callback_content,
              w.origin_amount AS original_amount, w.coupon_reduce_amount, w.final_amount, p.ts
       FROM wide w JOIN payment_info p ON p.order_id = w.order_id WHERE p.payment_status = '1602'""")
def pay_success(spark, folder):
    return trade.pay_success(trade.payment_slice(topics.change_log(spark, folder)), order_detail_wide(spark, folder))


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_day FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_by_key(spark, folder):
    orders = stored(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"))
    return changelog.latest_by_key(orders, "o_custkey", ["o_day", "o_orderkey"])


# ================================================================ dimensions

@query("""WITH latest AS (
         SELECT o_custkey, max(strftime(o_orderdate, '%Y-%m-%d')) AS seen,
                arg_max(CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderpriority END,
                        CASE WHEN o_orderstatus <> 'P' THEN (o_orderdate, o_orderkey) END) AS priority
         FROM orders GROUP BY o_custkey)
       SELECT CAST(coalesce(c_custkey, o_custkey) AS VARCHAR) AS id, c_name AS name,
              coalesce(priority, c_mktsegment) AS segment, seen
       FROM customer FULL OUTER JOIN latest ON c_custkey = o_custkey""")
def dim_upsert(spark, folder):
    """Partial updates from orders, folded and merged into the customer dimension."""
    base = stored(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.lit(None).cast("string").alias("seen"))
    updates = stored(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("segment"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen"), topics.utc_ms("o_orderdate").alias("_seq"),
        F.col("o_orderkey").alias("pos"))
    return dim.merge_tables(base, dim.merge_partial(updates, "id", ("_seq", "pos")), "id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7")
def dim_lookup(spark, folder):
    return dim.lookup_rows(stored(spark, folder, "customer"), c_mktsegment="BUILDING", c_nationkey=7).select(
        "c_custkey", "c_name")


@query("""WITH one AS (SELECT c_nationkey, c_mktsegment, min(c_name) AS contact FROM customer GROUP BY ALL)
       SELECT s_suppkey, s_name, contact FROM supplier
       LEFT JOIN one ON s_nationkey = c_nationkey
            AND CASE WHEN s_acctbal < 5000 THEN 'BUILDING' ELSE 'NOBODY' END = c_mktsegment""")
def dim_enrich_multi_key(spark, folder):
    suppliers = stored(spark, folder, "supplier").withColumn(
        "segment", F.when(F.col("s_acctbal") < 5000, "BUILDING").otherwise("NOBODY"))
    customers = stored(spark, folder, "customer")
    return dim.enrich(suppliers, customers, {"s_nationkey": "c_nationkey", "segment": "c_mktsegment"},
                      {"contact": "c_name"}).select("s_suppkey", "s_name", "contact")


# ================================================================ keywords

_RUN = r"[\p{L}\p{M}\p{N}]+"
_WORDS = r"""words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+')) AS keyword FROM documents)"""


def _searches(spark, folder) -> DataFrame:
    """Documents as search texts, one second apart."""
    return stored(spark, folder, "documents").select(
        F.col("text").alias("full_word"), "doc_id", F.timestamp_seconds("doc_id").alias("row_time"))


@query(f"WITH {_WORDS} SELECT doc_id, keyword, count(*) AS times FROM words GROUP BY ALL")
def keyword_explode(spark, folder):
    words = keywords.explode_tokens(_searches(spark, folder).drop("row_time"))
    return words.groupBy("doc_id", "keyword").agg(F.count(F.lit(1)).alias("times"))


@query(f"""WITH {_WORDS} SELECT strftime(make_timestamp((doc_id // 100) * 100000000), '%Y-%m-%d %H:%M:%S') AS stt,
       strftime(make_timestamp((doc_id // 100 + 1) * 100000000), '%Y-%m-%d %H:%M:%S') AS edt, 'SEARCH' AS source,
       keyword, count(*) AS keyword_count FROM words GROUP BY ALL""")
def keyword_window(spark, folder):
    words = keywords.explode_tokens(_searches(spark, folder).drop("doc_id"))
    return keywords.keyword_window(words, "100 seconds", tz=UTC, emit_time=False)


@query(SQL["keyword_window"])
def keyword_window_sql(spark, folder):
    """The same through SQL, with the keyword function in a lateral join."""
    textfns.register_sql(spark, "keywords_of")
    searches = _searches(spark, folder).drop("doc_id")
    words = spark.sql("SELECT keyword, row_time FROM {searches}, LATERAL keywords_of(full_word) AS t(keyword)",
                      searches=searches)
    return keywords.keyword_window(words, "100 seconds", tz=UTC, emit_time=False)


@query(f"""WITH {_WORDS}, known AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{_RUN}')) AS keyword
                                    FROM benchmark)
       SELECT keyword, count(*) AS times FROM words WHERE keyword IN (SELECT keyword FROM known) GROUP BY ALL""")
def keyword_dictionary(spark, folder):
    """Only words that occur in the benchmark texts count."""
    known = keywords.explode_tokens(stored(spark, folder, "benchmark"), "text").select("keyword")
    words = keywords.explode_tokens(_searches(spark, folder).select("full_word"), dictionary=known)
    return words.groupBy("keyword").agg(F.count(F.lit(1)).alias("times"))


# ================================================================ cells

@query(f"""WITH {CELLS_SQL} SELECT "row", family, qualifier, value, ts FROM live
       QUALIFY row_number() OVER (PARTITION BY "row", family, qualifier ORDER BY ts DESC, value DESC) = 1""")
def cells_latest(spark, folder):
    return cells.latest(topics.cell_log(spark, folder)).drop("type")


@query(f"""WITH {CELLS_SQL}, newest AS (
       SELECT * FROM puts WHERE "row" >= '1001' AND "row" < '5009'
       QUALIFY row_number() OVER (PARTITION BY "row", family, qualifier ORDER BY ts DESC, value DESC NULLS LAST) <= 2)
       SELECT "row", family, qualifier, value, ts, 'Put' AS type FROM newest
       UNION ALL SELECT "row", 'f1', 'status', NULL, ts, 'DeleteColumn' FROM gone
       WHERE st = 'F' AND "row" >= '1001' AND "row" < '5009'
       UNION ALL SELECT "row", 'f2', NULL, NULL, ts, 'DeleteFamily' FROM gone
       WHERE st = 'O' AND "row" >= '1001' AND "row" < '5009'""")
def cells_scan(spark, folder):
    return cells.scan(topics.cell_log(spark, folder), "1001", "5009", versions=2, raw=True)


@query(f"""WITH {CELLS_SQL}, ranked AS (
       SELECT *, (SELECT count(DISTINCT (q.ts, q.value)) FROM puts q WHERE q."row" = p."row" AND q.family = p.family
                  AND q.qualifier = p.qualifier AND (q.ts > p.ts OR (q.ts = p.ts AND q.value > p.value))) AS newer,
              row_number() OVER (PARTITION BY "row", family, qualifier, ts, value) AS copy
       FROM puts p WHERE "row" >= '1001' AND "row" < '5009'),
       shown AS (
       SELECT * FROM ranked QUALIFY newer < 3 AND
              row_number() OVER (PARTITION BY "row", family, qualifier ORDER BY newer, copy) <= 3)
       SELECT "row", family, qualifier, value, ts, 'Put' AS type FROM shown
       UNION ALL SELECT "row", CASE st WHEN 'F' THEN 'f1' ELSE 'f2' END, CASE st WHEN 'F' THEN 'status' END, NULL, ts,
              CASE st WHEN 'F' THEN 'DeleteColumn' ELSE 'DeleteFamily' END
       FROM gone WHERE "row" >= '1001' AND "row" < '5009'""")
def cells_scan_versions(spark, folder):
    """Only puts count as versions; every tombstone of the range is shown."""
    return cells.scan(topics.cell_log(spark, folder), "1001", "5009", versions=3, raw=True)


# ================================================================ functions

@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
       strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS time_east,
       (epoch_us(date_trunc('day', ts)) // 1000) AS day_ms, (epoch_us(date_trunc('second', ts)) // 1000) AS second_ms,
       (epoch_us(date_trunc('day', ts)) // 1000) - 28800000 AS day_ms_east, (epoch_us(ts) // 1000) // 1000 AS row_second FROM events""")
def time_functions(spark, folder):
    events = stored(spark, folder, "events").select("event_id", topics.utc_ms("ts").alias("ts"))
    timed = events.select("event_id", "ts", timefns.to_date_text("ts", UTC).alias("day"),
                          timefns.to_datetime_text("ts", UTC).alias("time"),
                          timefns.to_datetime_text("ts").alias("time_east"))
    return timed.select(
        "event_id", timefns.date_of_text("time").alias("day"), "time", "time_east",
        timefns.to_millis("day", tz=UTC).alias("day_ms"),
        timefns.to_millis("time", full=True, tz=UTC).alias("second_ms"),
        timefns.to_millis("day").alias("day_ms_east"), F.unix_seconds(timefns.row_time("ts")).alias("row_second"))


@query(f"""WITH {PAGE_LOG_SQL} SELECT event_id, '{{"mid":"' || mid || '"' ||
       CASE WHEN last_page_id IS NULL THEN '' ELSE ',"last_page_id":"' || last_page_id || '"' END ||
       ',"ts":' || ts || '}}' AS value FROM page_log""")
def json_value(spark, folder):
    rows = topics.page_log(spark, folder).select("event_id", "common.mid", "page.last_page_id", "ts")
    return sinks.to_json_value(rows, "event_id")


# ================================================================ sinks: written and read back

@query(SQL["latest_by_key"])
def upsert_sink(spark, folder):
    orders = stored(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"))
    path = session.shared_dir(spark, "upsert")
    sinks.upsert(orders, path, "o_custkey", ["o_day", "o_orderkey"])
    return sinks.read_upserted(spark, path, "o_custkey", ["o_day", "o_orderkey"])


@query(f"""WITH {CHANGES_SQL} SELECT id, name, nation, segment FROM user_info
       WHERE type IN ('insert', 'bootstrap-insert')""")
def dim_sink(spark, folder):
    path = session.shared_dir(spark, "dims")
    dim.upsert_dims(_dim_routed(spark, folder), 0, path, _DIM_RULES)
    return dim.read_dim(spark, path, "dim_user_info", "id,name,nation,segment")


@query("""WITH placed AS (SELECT *, row_number() OVER () AS pos FROM events)
       SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, event_id FROM placed
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m') DESC, pos DESC) = 1""")
def latest_by_key_same_time(spark, folder):
    """Events that only know their month: of equal times the one later in the file counts."""
    events = sources.with_position(spark.read.parquet(f"{folder}/events.parquet")).select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "event_id",
        F.date_format("ts", "yyyy-MM").alias("month"), "pos")
    return changelog.latest_by_key(events, "user_id", ["month", "pos"]).drop("month", "pos")


_PLACED_RULE = {"source_table": "account", "sink_table": "dim_account", "sink_columns": "id,priority,status", "sink_pk": "id",
                "sink_extend": None}
_PLACED_SQL = """WITH placed AS (SELECT *, row_number() OVER () AS pos, CAST(o_custkey AS VARCHAR) AS id,
         o_orderstatus = 'P' AND o_orderkey % 5 = 0 AS gone FROM orders),
       removed AS (SELECT id, max(pos) FILTER (gone) AS last_gone FROM placed GROUP BY id),
       writes AS (SELECT p.* FROM placed p JOIN removed USING (id) WHERE NOT gone AND pos > coalesce(last_gone, 0))
       SELECT id, arg_max(o_orderpriority, pos) FILTER (o_orderstatus <> 'F') AS priority,
              arg_max(o_orderstatus, pos) AS status FROM writes GROUP BY id"""


def _account_changes(spark, folder, where: str = "true") -> DataFrame:
    """Partial updates and removals of accounts made from orders, all of one instant: only positions tell them apart."""
    orders = sources.with_position(spark.read.parquet(f"{folder}/orders.parquet")).where(where)
    data = F.create_map(F.lit("id"), F.col("o_custkey").cast("string"), F.lit("priority"),
                        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")), F.lit("status"), F.col("o_orderstatus"))
    gone = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 5 == 0)
    events = orders.select(F.lit("edu").alias("database"), F.lit("account").alias("table"),
                           F.when(gone, "delete").otherwise("update").alias("type"), data.alias("data"), F.lit("7").alias("ts"), "pos")
    return cdc.route_dim(events, spark.createDataFrame([_PLACED_RULE], schemas.DIM_RULE), apply_deletes=True)


@query(_PLACED_SQL)
def dim_sink_same_time(spark, folder):
    """Writes and removals of one instant, in two batches of which the first holds the later rows."""
    root = session.shared_dir(spark, "accounts")
    for number, part in enumerate(("o_orderkey % 2 = 1", "o_orderkey % 2 = 0")):
        dim.upsert_dims(_account_changes(spark, folder, part), number, root, [_PLACED_RULE])
    return dim.read_dim(spark, root, "dim_account", "id,priority,status")


@query(_PLACED_SQL)
def dim_sink_compacted(spark, folder):
    """The same over a level that stands for two batches, and a batch that came later."""
    root = session.shared_dir(spark, "accounts")
    for number in range(3):
        if number == 2:
            dim.compact_dim(spark, root, "dim_account", "id,priority,status")
        dim.upsert_dims(_account_changes(spark, folder, f"o_orderkey % 3 = {number}"), number, root, [_PLACED_RULE])
    return dim.read_dim(spark, root, "dim_account", "id,priority,status")


@query(SQL["latest_by_key"])
def upsert_compacted(spark, folder):
    """An upsert log of a level that stands for two batches, and of later batches beside it."""
    orders = stored(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"))
    path, order = session.shared_dir(spark, "upsert"), ["o_day", "o_orderkey"]
    for number in range(4):
        if number == 2:
            sinks.compact_upserted(spark, path, "o_custkey", order)
        sinks.upsert(orders.where(F.col("o_orderkey") % 4 == number), path, "o_custkey", order)
    return sinks.read_upserted(spark, path, "o_custkey", order)


@query(f"""WITH {CHANGES_SQL} SELECT 'dwd_order_info' AS sink_table,
       '{{"id":"' || id || '","session_id":"' || session_id || '","ts":"' || ts || '"}}' AS value FROM order_info
       UNION ALL SELECT 'dwd_user', '{{"id":"' || id || '","name":"' || name || '","ts":"' || ts || '"}}'
       FROM user_info WHERE type = 'insert'
       UNION ALL SELECT 'dwd_order_detail',
         '{{"order_id":"' || order_id || '","final_amount":"' || final_amount || '","ts":"' || ts || '"}}'
       FROM order_detail""")
def routed_sink(spark, folder):
    rules = spark.createDataFrame(_DETAIL_RULES, schemas.DETAIL_RULE)
    path = session.shared_dir(spark, "routed")
    sinks.routed(cdc.drop_control(topics.change_log(spark, folder)), path,
                 route=lambda batch: cdc.route_detail(batch, rules))
    return spark.read.text(path).select("sink_table", "value")


@query(SQL["log_split_one_pass"])
def fan_out_sink(spark, folder):
    path = session.shared_dir(spark, "outputs")
    sinks.fan_out(logs.split_tagged(parse.drop_bad(topics.raw_log(spark, folder), record=parse.RECORD)), path)
    return spark.read.text(path).groupBy("output", F.get_json_object("value", "$.common.mid").alias("mid")).agg(
        F.count(F.lit(1)).alias("records"))


# ================================================================ streaming forms
#
# The stored table is read as a stream until its end. What waits for the watermark to pass at the end of the input is not
# given out, so the SQL leaves out what is younger than the last event by the delay.

def _streamed(df: DataFrame) -> DataFrame:
    """Run a stream to the end of its input and read what it wrote."""
    spark = df.sparkSession
    spark.conf.set(session.STATE_STORE_CONF, session.RECOMMENDED[session.STATE_STORE_CONF])
    target = session.shared_dir(spark, "stream")
    sinks.append(df, f"{target}/out", f"{target}/checkpoint", "parquet").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{target}/out")


@query(SQL["is_new_repair"])
def stream_is_new_repair(spark, folder):
    return _streamed(logs.repair_is_new(topics.page_stream(spark, folder), UTC).select(
        "common.mid", "ts", "event_id", "common.is_new"))


@query(SQL["unique_visitors"])
def stream_unique_visitors(spark, folder):
    pages = timefns.with_event_time(topics.page_stream(spark, folder), delay="15 seconds")
    return _streamed(_view(traffic.unique_visitors(pages, UTC, ["event_id"])))


@query(f"WITH {PAGE_LOG_SQL}, {_JUMP} SELECT mid, page_id, ts, event_id FROM jump "
       "WHERE ts + 21600000 < (SELECT max(ts) FROM page_log)")
def stream_user_jumps(spark, folder):
    pages = timefns.with_event_time(topics.page_stream(spark, folder), delay="0 seconds")
    return _streamed(_view(traffic.user_jumps(pages, "6 hours", ["event_id"])))


@query(f"{_PLAYS} HAVING max(ts) + 7200000 <= (SELECT max(ts) FROM page_log) - 5000")
def stream_play_sessions(spark, folder):
    plays = timefns.with_event_time(_plays(topics.page_stream(spark, folder)), delay="5 seconds")
    return _streamed(learn.play_sessions(plays, "2 hours", ["event_id"]))


@query(f"SELECT * FROM ({_LOGINS}) WHERE ts + 15000 < (SELECT max(epoch_us(ts) // 1000) FROM events)")
def stream_first_login(spark, folder):
    pages = timefns.with_event_time(topics.page_stream(spark, folder), delay="5 seconds")
    return _streamed(user.first_login(pages, tie=["event_id"]).select("common.mid", "ts", "event_id"))


@query(f"""WITH {PAGE_LOG_SQL} SELECT strftime(make_timestamp((ts // 3600000) * 3600000000), '%Y-%m-%d %H:%M:%S') AS stt,
       vc AS "versionCode", sc AS "sourceId", ar, is_new AS "isNew", count(*) AS "pageViewCount",
       CAST(sum(during_time) AS BIGINT) AS "totalDuringTime",
       count(*) FILTER (last_page_id IS NULL) AS "uvCount", count(*) FILTER (page_id = 'order') AS "jumpSessionCount"
       FROM page_log WHERE (ts // 3600000 + 1) * 3600000 <= (
         SELECT least(max(ts) FILTER (last_page_id IS NULL), max(ts) FILTER (page_id = 'order')) - 15000 FROM page_log)
       GROUP BY ALL""")
def stream_traffic_window(spark, folder):
    """Three streams in one window; session starts and order pages stand for the two detail topics."""
    pages = topics.page_stream(spark, folder)
    sums = window_sums.traffic_window(pages, logs.session_starts(pages), logs.page_slice(pages, "order"), "1 hour",
                                      "15 seconds", UTC, emit_time=False, one_watermark=False)
    return _streamed(sums.select("stt", "versionCode", "sourceId", "ar", "isNew", "pageViewCount", "totalDuringTime",
                                 "uvCount", "jumpSessionCount"))


_QUIET = f"""WITH {PAGE_LOG_SQL}, sums AS (
       SELECT strftime(make_timestamp((ts // 3600000) * 3600000000), '%Y-%m-%d %H:%M:%S') AS stt,
       vc AS "versionCode", sc AS "sourceId", ar, is_new AS "isNew", count(*) AS "pageViewCount",
       count(*) FILTER (last_page_id IS NULL) AS "uvCount"
       FROM page_log WHERE (ts // 3600000 + 1) * 3600000 <= (SELECT max(ts) - 15000 FROM page_log) GROUP BY ALL)"""


@query(f"{_QUIET} SELECT *, 0::BIGINT AS \"jumpSessionCount\" FROM sums")
def stream_traffic_quiet_topic(spark, folder):
    """A topic without any rows holds no window back."""
    pages = topics.page_stream(spark, folder)
    sums = window_sums.traffic_window(pages, logs.session_starts(pages), logs.page_slice(pages, "no such page"), "1 hour",
                                      "15 seconds", UTC, emit_time=False)
    return _streamed(sums.select("stt", "versionCode", "sourceId", "ar", "isNew", "pageViewCount", "uvCount", "jumpSessionCount"))


@query(f"""{_QUIET} SELECT sums.*, r_name AS "sourceName", n_name AS "provinceName" FROM sums
       LEFT JOIN region ON "sourceId" = CAST(r_regionkey AS VARCHAR)
       LEFT JOIN nation ON ar = CAST(n_nationkey AS VARCHAR)""")
def stream_traffic_names(spark, folder):
    """Sums of a stream with names out of dimension tables, which are read anew for every batch."""
    root = session.shared_dir(spark, "names")
    tables = {"dim_base_source": ("region", "r_regionkey", "r_name", "ID,SOURCE_SITE"),
              "dim_base_province": ("nation", "n_nationkey", "n_name", "ID,NAME")}
    rules = [{"source_table": table, "sink_table": name, "sink_columns": columns, "sink_pk": "ID"}
             for name, (table, _, _, columns) in tables.items()]
    for number, (name, (table, key, value, columns)) in enumerate(tables.items()):
        pair = dict(zip(columns.split(","), (F.col(key).cast("string"), F.col(value))))
        data = F.create_map(*[part for column, cell in pair.items() for part in (F.lit(column), cell)])
        dim.upsert_dims(stored(spark, folder, table).select(F.lit(name).alias("sink_table"), F.lit("1").alias("ts"),
                                                           data.alias("data")), number, root, rules)
    pages = topics.page_stream(spark, folder)
    sums = window_sums.traffic_window(pages, logs.session_starts(pages), logs.page_slice(pages, "no such page"), "1 hour",
                                      "15 seconds", UTC, emit_time=False)

    def named(batch: DataFrame) -> DataFrame:
        return window_sums.with_names(batch, dim.read_dim(spark, root, "dim_base_source", "ID,SOURCE_SITE", "ID"),
                                      dim.read_dim(spark, root, "dim_base_province", "ID,NAME", "ID"))

    columns = ["stt", "versionCode", "sourceId", "sourceName", "ar", "provinceName", "isNew", "pageViewCount", "uvCount"]
    sinks.ordered_append(sums, f"{root}/sums", columns, (), f"{root}/checkpoint", each=named).awaitTermination()
    return spark.read.parquet(f"{root}/sums").drop("batch")


@query(f"""WITH {RAW_LOG_SQL}, outputs AS (
       SELECT 'dwd_traffic_error_log' AS output FROM log WHERE event_type = 'error'
       UNION ALL SELECT 'dwd_traffic_start_log' FROM log WHERE {_STARTED}
       UNION ALL SELECT 'dwd_traffic_play_pre_process' FROM log WHERE event_type = 'click'
       UNION ALL SELECT 'dwd_traffic_page_log' FROM log WHERE event_type <> 'click' AND NOT {_STARTED}
       UNION ALL SELECT 'dwd_traffic_display_log' FROM (SELECT unnest(range(1, k % 3 + 1)) FROM log WHERE event_type = 'view')
       UNION ALL SELECT 'dwd_traffic_action_log' FROM (SELECT unnest(range(1, k % 4 + 1)) FROM log WHERE event_type = 'purchase')
       UNION ALL SELECT 'dirty_data' FROM events WHERE event_type = 'view' AND value < 5)
       SELECT output, count(*) AS records FROM outputs GROUP BY ALL""")
def stream_site_log(spark, folder):
    """The whole job in one streaming query: repaired flags, six outputs, and the dirty rows as the seventh."""
    out, checkpoint = _job_folder(spark)
    jobs.split_site_log(topics.raw_log(spark, folder, stream=True).select("value"), out, checkpoint, UTC).awaitTermination()
    return spark.read.text(out).groupBy("output").agg(F.count(F.lit(1)).alias("records"))


# The jobs over tables, from JSON text to the keyed table behind their log. Lines, orders, pages and payments of a session
# meet several times each; the log keeps what decides between them.

_WITHIN, _WITHIN_MS = "6 hours", 21_600_000
_LINES = f"""{SESSIONS_SQL},
       lines AS (
       SELECT d.id, d.sid AS order_id, d.mid AS user_id, CAST(d.k AS VARCHAR) AS course_id, CAST(o.k AS VARCHAR) AS province_id,
              d.day AS date_id, o.sid AS session_id, p.sc AS source_id, d.time AS create_time,
              CAST(d.k AS VARCHAR) AS origin_amount, d.event AS coupon_reduce_amount, d.event AS final_amount,
              't' || o.event AS out_trade_no, CAST(o.k AS VARCHAR) AS trade_body, CAST(d.ts AS VARCHAR) AS ts
       FROM acts d JOIN acts o ON d.sid = o.sid AND o.event_type = 'click' AND abs(o.ts - d.ts) <= {_WITHIN_MS}
       LEFT JOIN acts p ON p.sid = o.sid AND p.page_id = 'order' AND abs(p.ts - d.ts) <= {_WITHIN_MS}
       WHERE d.event_type = 'purchase'
       QUALIFY row_number() OVER (PARTITION BY d.id ORDER BY d.ts DESC, o.ts DESC, 't' || o.event DESC, p.ts DESC, p.sc DESC) = 1)"""


def _sessions(spark, folder, stream: bool) -> tuple[DataFrame, DataFrame]:
    read = topics.stored_stream if stream else stored
    return topics.session_topics(read(spark, folder, "events"))


def _job_folder(spark) -> tuple[str, str]:
    spark.conf.set(session.STATE_STORE_CONF, session.RECOMMENDED[session.STATE_STORE_CONF])
    root = session.shared_dir(spark, "jobs")
    return f"{root}/out", f"{root}/checkpoint"


def _batch_lines(spark, folder) -> DataFrame:
    changes, pages = _sessions(spark, folder, False)
    events = jobs._change_time(changes, "0 seconds", "ms", True)
    page_log = jobs._page_table(pages, "0 seconds", True)
    return trade.order_detail(trade.detail_slice(events, "row_time"), trade.order_slice(events, "row_time"),
                              trade.order_pages(page_log, "row_time"), _WITHIN)


@query(f"WITH {_LINES} SELECT * FROM lines")
def order_detail_within(spark, folder):
    return _batch_lines(spark, folder)


@query(SQL["order_detail_within"])
def stream_order_detail(spark, folder):
    out, checkpoint = _job_folder(spark)
    jobs.order_detail(*_sessions(spark, folder, True), out, checkpoint, _WITHIN).awaitTermination()
    return jobs.read_table(spark, out, jobs.ORDER_DETAIL).drop("row_op_ts")


@query(f"""WITH {_LINES} SELECT w.id, w.order_id, w.user_id, w.course_id, w.province_id, w.date_id, 'a' || p.event AS alipay_trade_no,
              CAST(p.k AS VARCHAR) AS trade_body, '1101' AS payment_type, '1602' AS payment_status, p.time AS callback_time,
              p.event AS callback_content, w.origin_amount AS original_amount, w.coupon_reduce_amount, w.final_amount,
              CAST(p.ts AS VARCHAR) AS ts
       FROM lines w JOIN acts p ON p.sid = w.order_id AND p.event_type = 'view' AND p.event_id % 2 = 0
            AND abs(p.ts - CAST(w.ts AS BIGINT)) <= {_WITHIN_MS}
       QUALIFY row_number() OVER (PARTITION BY w.id ORDER BY p.ts DESC, p.time DESC, 'a' || p.event DESC) = 1""")
def pay_success_within(spark, folder):
    events = jobs._change_time(_sessions(spark, folder, False)[0], "0 seconds", "ms", True)
    lines = jobs._with_change_time(_batch_lines(spark, folder), "0 seconds", "ms").drop("_ms")
    return trade.pay_success(trade.payment_slice(events, "row_time"), lines, _WITHIN)


@query(SQL["pay_success_within"])
def stream_pay_success(spark, folder):
    """Both jobs, the second over the first one's log."""
    out, checkpoint = _job_folder(spark)
    changes, pages = _sessions(spark, folder, True)
    jobs.order_detail(changes, pages, out, checkpoint, _WITHIN).awaitTermination()
    log = f"{out}/{jobs.ORDER_DETAIL}"
    details = spark.readStream.schema(spark.read.parquet(log).schema).parquet(log)
    jobs.pay_success(changes, details, out, checkpoint, _WITHIN).awaitTermination()
    return jobs.read_table(spark, out, jobs.PAY_SUCCESS).drop("row_op_ts")


@query(f"""WITH {SESSIONS_SQL} SELECT u.mid AS user_id, u.time AS register_time, u.day AS register_date, 'web' AS channel,
              p.ar AS province_id, p.vc AS version_code, p.sc AS source_id, p.mid AS mid_id, 'brand' AS brand, 'model' AS model,
              'os' AS operate_system, CAST(u.ts AS VARCHAR) AS ts
       FROM acts u JOIN acts p ON p.uid = u.mid AND abs(p.ts - u.ts) <= {_WITHIN_MS} WHERE u.event_type = 'signup'
       QUALIFY row_number() OVER (PARTITION BY u.mid ORDER BY u.ts DESC, u.time DESC, p.ts DESC, p.ar DESC, p.vc DESC) = 1""")
def register_within(spark, folder):
    changes, pages = _sessions(spark, folder, False)
    events = jobs._change_time(changes, "0 seconds", "ms", True)
    page_log = jobs._page_table(pages, "0 seconds", True)
    return user.register(user.user_slice(events, "row_time"), user.login_dims(page_log, None, "row_time"), _WITHIN)


@query(SQL["register_within"])
def stream_register(spark, folder):
    out, checkpoint = _job_folder(spark)
    jobs.register(*_sessions(spark, folder, True), out, checkpoint, _WITHIN).awaitTermination()
    return jobs.read_table(spark, out, jobs.REGISTRATIONS).drop("row_op_ts")


@query(f"""WITH {_WORDS} SELECT strftime(make_timestamp((doc_id // 100) * 100000000), '%Y-%m-%d %H:%M:%S') AS stt,
       keyword, count(*) AS keyword_count FROM words
       WHERE (doc_id // 100 + 1) * 100 <= (SELECT max(doc_id) - 5 FROM documents) GROUP BY ALL""")
def stream_keyword_window(spark, folder):
    texts = topics.stored_stream(spark, folder, "documents").select(
        F.col("text").alias("full_word"), F.timestamp_seconds("doc_id").alias("row_time"))
    words = keywords.explode_tokens(texts.withWatermark("row_time", "5 seconds"))
    return _streamed(keywords.keyword_window(words, "100 seconds", tz=UTC, emit_time=False).select(
        "stt", "keyword", "keyword_count"))
