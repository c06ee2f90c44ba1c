"""Site log: visitor flag repair, six-way split, slices and flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidehouse import schemas, sized
from tidehouse.functions import timefns
from tidehouse.operators.parse import DIRTY, RECORD

OUTPUTS = ("error", "start", "video", "display", "action", "page")


# ---------------------------------------------------------------- new/old visitor flag

def first_days(df: DataFrame, tz: str = timefns.DEFAULT_TZ) -> DataFrame:
    """Per device the day its first visit counts for: the day of its first record, or the day before when that
    record already came flagged as old.

    Time and flag are packed into one number, so that this is a hash aggregate with map-side combine: a device with a
    large share of all rows sends one row per map task. Among records of one instant a new-flagged one comes first.
    """
    flagged_old = F.when(F.col("common.is_new") == "1", 0).otherwise(1)
    packed = F.min(F.col("ts") * 2 + flagged_old).alias("_packed")
    first = df.where(F.col("common.mid").isNotNull()).groupBy(F.col("common.mid").alias("_mid")).agg(packed)
    first_ts, was_old = F.floor(F.col("_packed") / 2).cast("bigint"), F.pmod(F.col("_packed"), F.lit(2))
    return first.select("_mid", timefns.local_day(first_ts - was_old * timefns.DAY_MS, tz).alias("_first_day"))


def repair_is_new(df: DataFrame, tz: str = timefns.DEFAULT_TZ) -> DataFrame:
    """Set ``common.is_new`` to ``'0'`` on records that claim a new visitor on a day after the device's first.

    Batch form. Only records that claim ``'1'`` can change, so only they are shuffled to meet the first day of their
    device; all others pass by. The join has one row per device on one side, and AQE splits a hot device on the other.
    On a stream the state processor does the same in arrival order.
    """
    if df.isStreaming:
        from tidehouse.streaming import stateful
        return stateful.repair_is_new(df, tz)
    claims_new = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    flagged, rest = df.where(claims_new), df.where(~claims_new)
    joined = flagged.join(sized.splittable(first_days(df, tz), "_mid"), F.col("common.mid") == F.col("_mid"), "left")
    is_new = F.when(timefns.local_day("ts", tz) != F.col("_first_day"), "0").otherwise(F.col("common.is_new"))
    repaired = joined.withColumn("common", F.col("common").withField("is_new", is_new))
    return repaired.select(*df.columns).unionByName(rest)


# ---------------------------------------------------------------- split

def _is_page() -> Column:
    return F.col("start").isNull() & F.col("appVideo").isNull()


def explode_items(df: DataFrame, array: str, item: str, with_ts: bool = True) -> DataFrame:
    """One row per element of an array column, beside ``common`` and ``page``."""
    rest = ["common", "page"] + (["ts"] if with_ts else [])
    return df.select(F.explode(array).alias(item), *rest)


def _object(*members: str) -> Column:
    """JSON text of an object from columns that hold its members as text; null members are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _item_texts(array: str, item: str, *rest: str) -> Column:
    return F.transform(array, lambda x: F.concat(F.lit(f'{{"{item}":'), x, F.lit(","), F.concat_ws(",", *rest), F.lit("}")))


def _with_members(df: DataFrame) -> DataFrame:
    """``_m``: all members of the record's own text, declared or not, by name; a repaired visitor flag is put in.

    Null where the text cannot be read so, as when a name is twice in an object (see ``session.RECOMMENDED``).
    """
    members = F.map_filter(F.from_json(RECORD, "map<string,variant>"), lambda _, v: v.isNotNull() & ~F.is_variant_null(v))
    df = df.select("*", F.explode(F.array(members)).alias("_sent"))
    sent = F.col("_sent")["common"]
    flag = F.create_map(F.lit("is_new"), F.parse_json(F.lit('"0"')))
    others = F.map_filter(F.try_variant_get(sent, "$", "map<string,variant>"), lambda name, _: name != "is_new")
    is_repaired = (F.col("common.is_new") == "0") & ~F.try_variant_get(sent, "$.is_new", "string").eqNullSafe("0")
    repaired = F.transform_values("_sent", lambda name, v: F.when(
        name == "common", F.to_variant_object(F.map_concat(others, flag))).otherwise(v))
    return df.select("*", F.explode(F.array(F.when(is_repaired, repaired).otherwise(F.col("_sent")))).alias("_m"))


def _texts(df: DataFrame, action_ts: bool) -> DataFrame:
    """The columns, and the JSON texts of what a record may give: ``_error``, ``_whole`` (without its error), ``_rest``
    (a page view), ``_display`` and ``_action`` (arrays). Every part is written once.

    With the record's own text at hand they hold all its members; typed fields alone know the declared ones.
    """
    def member(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), text)

    def array_text(name: str) -> Column:
        return F.concat(F.lit("["), F.array_join(name, ","), F.lit("]"))

    parts = {name: F.to_json(name) for name in ("common", "page", "appVideo")}
    parts |= {name: F.col(name) for name in ("start", "err")} | {name: array_text(name) for name in ("displays", "actions")}
    arrays = {name: F.col(name) for name in ("displays", "actions")}
    has_record = RECORD in df.columns
    columns = df.columns
    if has_record:
        df = _with_members(df)
        columns = [*columns, "_m"]
        sent = F.col("_m")
        parts |= {name: F.coalesce(F.to_json(sent[name]), parts[name]) for name in ("common", "page")}
        arrays = {name: F.coalesce(F.transform(F.try_variant_get(sent[name], "$", "array<variant>"), lambda v: F.coalesce(
            F.to_json(v), F.lit("null"))), own) for name, own in arrays.items()}
    parts["ts"] = F.col("ts").cast("string")
    df = df.select(*columns, *[member(name, text).alias(f"_{name}") for name, text in parts.items()],
                   *[own.alias(f"_{name}_items") for name, own in arrays.items()])

    def text(own: Column, *without: str) -> Column:
        if not has_record:
            return own
        left = F.map_filter("_m", lambda name, _: ~name.isin(*without)) if without else F.col("_m")
        return F.coalesce(F.to_json(left), own)

    whole = ("_common", "_page", "_appVideo", "_start", "_displays", "_actions", "_ts")
    return df.select(
        *[c for c in columns if c != "_m"],
        F.when(F.col("err").isNotNull(), text(_object(*whole, "_err"))).alias("_error"),
        F.when(~_is_page(), text(_object(*whole), "err")).alias("_whole"),
        F.when(_is_page(), text(_object("_common", "_page", "_ts"), "err", "start", "appVideo", "displays", "actions"))
        .alias("_rest"),
        F.when(_is_page(), _item_texts("_displays_items", "display", "_common", "_page", "_ts")).alias("_display"),
        F.when(_is_page(), _item_texts("_actions_items", "action", "_common", "_page", *(["_ts"] if action_ts else [])))
        .alias("_action"))


def split_log(df: DataFrame, action_ts: bool = False) -> dict[str, DataFrame]:
    """The six detail outputs of the site log, as six DataFrames over one parsed input.

    Error records are copied whole and then go on without their error, so a record may show up twice. A start record
    ends there, then a video record; what is left is a page view with its displays and actions. Action rows carry no
    outer time unless ``action_ts``. Columns that are not part of the log schema are carried along in the whole-record
    outputs. Where the input has the record's own text (``parse.RECORD``), every output has its own in that column, with
    all members that the rule leaves, declared or not.
    """
    has_record = RECORD in df.columns
    columns = list(df.columns)
    texts = _texts(df, action_ts) if has_record else df

    def cut(rows: DataFrame, text: str, *without: str) -> DataFrame:
        return rows.withColumn(RECORD, F.col(text)).select(*[c for c in columns if c not in without]) if has_record \
            else rows.drop(*without)

    def items(array: str, item: str, with_ts: bool = True) -> DataFrame:
        if not has_record:
            return explode_items(pages, array, item, with_ts)
        rest = ["common", "page"] + (["ts"] if with_ts else [])
        both = F.arrays_zip(F.col(array).alias(item), F.col(f"_{item}").alias(RECORD))
        return pages.select(F.explode(both).alias("_i"), *rest).select(f"_i.{item}", *rest, f"_i.{RECORD}")

    pages = texts.where(_is_page())
    return {
        "error": cut(texts.where(F.col("err").isNotNull()), "_error"),
        "start": cut(texts.where(F.col("start").isNotNull()), "_whole", "err"),
        "video": cut(texts.where(F.col("start").isNull() & F.col("appVideo").isNotNull()), "_whole", "err"),
        "display": items("displays", "display"),
        "action": items("actions", "action", with_ts=action_ts),
        "page": cut(pages, "_rest", "err", "start", "appVideo", "displays", "actions"),
    }


def split_tagged(df: DataFrame, action_ts: bool = False) -> DataFrame:
    """All six outputs in one pass, as rows ``(output, value)`` with the record as JSON text.

    One record is parsed once and fans out in place, without a shuffle and without reading the input once per output.
    With ``parse.RECORD`` among the columns, its text is read for the members that the schema does not declare. Dirty rows
    (``parse.with_dirty``) are a seventh output, ``dirty``, with their text as it came.
    """
    def tagged(output: Column | str, value: Column) -> Column:
        return F.struct((F.lit(output) if isinstance(output, str) else output).alias("output"), value.alias("value"))

    texts = _texts(df, action_ts)
    kind = F.when(F.col("start").isNotNull(), "start").when(F.col("appVideo").isNotNull(), "video").otherwise("page")
    outputs = [
        F.when(F.col("_error").isNotNull(), F.array(tagged("error", F.col("_error")))),
        F.array(tagged(kind, F.coalesce("_whole", "_rest"))),
        F.transform("_display", lambda x: tagged("display", x)),
        F.transform("_action", lambda x: tagged("action", x)),
    ]
    none = F.array().cast("array<struct<output:string,value:string>>")
    rows = F.concat(*[F.coalesce(o, none) for o in outputs])
    if DIRTY in df.columns:
        rows = F.when(F.col(DIRTY).isNotNull(), F.array(tagged(DIRTY, F.col(DIRTY)))).otherwise(rows)
    return texts.select(F.explode(rows).alias("o")).select("o.*")


# ---------------------------------------------------------------- slices

def page_slice(df: DataFrame, page_id: str | None = None, logged_in: bool = False) -> DataFrame:
    """Page views of one page and/or of logged-in users."""
    if page_id is not None:
        df = df.where(F.col("page.page_id") == page_id)
    if logged_in:
        df = df.where(F.col("common.uid").isNotNull())
    return df


def session_starts(df: DataFrame) -> DataFrame:
    """Page views without a previous page."""
    return df.where(F.col("page.last_page_id").isNull())


def search_terms(df: DataFrame) -> DataFrame:
    """Search texts with their time."""
    searched = df.where(F.col("page.item").isNotNull() & (F.col("page.item_type") == "keyword"))
    time = [F.col("row_time")] if "row_time" in df.columns else [timefns.row_time("ts").alias("row_time")]
    return searched.select(F.col("page.item").alias("full_word"), *time)


# ---------------------------------------------------------------- flat rows

def flatten_play(df: DataFrame, *carry: str) -> DataFrame:
    """Video records as flat play rows; ``carry`` names further columns to keep."""
    source = {
        "sourceId": "common.sc", "provinceId": "common.ar", "userId": "common.uid", "operatingSystem": "common.os",
        "channel": "common.ch", "isNew": "common.is_new", "model": "common.md", "machineId": "common.mid",
        "versionCode": "common.vc", "brand": "common.ba", "sessionId": "common.sid", "playSec": "appVideo.play_sec",
        "positionSec": "appVideo.position_sec", "videoId": "appVideo.video_id", "ts": "ts",
    }
    return df.select(*[F.col(source[name]).alias(name) for name in schemas.PLAY_COLUMNS], *carry)


def flatten_login(df: DataFrame, tz: str = timefns.DEFAULT_TZ) -> DataFrame:
    """Login records as flat rows."""
    time = timefns.to_datetime_text("ts", tz)
    value = {
        "userId": F.col("common.uid"), "dateId": F.substring(time, 1, 10), "loginTime": time,
        "sourceId": F.col("common.sc"), "channel": F.col("common.ch"), "provinceId": F.col("common.ar"),
        "versionCode": F.col("common.vc"), "midId": F.col("common.mid"), "brand": F.col("common.ba"),
        "model": F.col("common.md"), "operatingSystem": F.col("common.os"), "ts": F.col("ts"),
    }
    return df.select(*[value[name].alias(name) for name in schemas.LOGIN_COLUMNS])
