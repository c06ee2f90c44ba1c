"""JSON text to records, with three ways to treat text that cannot be parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidehouse import schemas

_BAD = "_bad"
#: Column for the record's own text beside the typed fields; ``logs`` builds whole-record outputs from it.
RECORD = "record"


def _cast_to(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast text leaves to their declared types, going down structs; text that is no number becomes null."""
    if have == want:
        return value
    if isinstance(want, T.StructType):
        fields = [_cast_to(value[f.name], have[f.name].dataType, f.dataType).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.try_cast(want)


def _parsed(raw: DataFrame, wire: T.StructType, value: str) -> DataFrame:
    with_bad = T.StructType([*wire.fields, T.StructField(_BAD, T.StringType())])
    record = F.from_json(value, with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    # A JSON array or scalar is no record either, although the parser would unwrap an array of one object.
    record = F.when(F.col(value).rlike(r"^[ \t\r\n]*\{"), record)
    # A generator's output is computed once; a plain column would be parsed again in every filter pushed below it.
    return raw.select("*", F.explode(F.array(record)).alias("_r"))


def _is_good() -> Column:
    return F.col("_r").isNotNull() & F.col(f"_r.{_BAD}").isNull()


def _typed(parsed: DataFrame, wire: T.StructType, typed: T.StructType, value: str,
           record: str | None = None) -> DataFrame:
    keep = [F.col(name) for name in parsed.columns if name not in (value, "_r")]
    keep += [F.col(value).alias(record)] if record else []
    fields = [_cast_to(F.col(f"_r.{f.name}"), wire[f.name].dataType, f.dataType).alias(f.name) for f in typed.fields]
    return parsed.select(*keep, *fields)


def split_dirty(raw: DataFrame, wire: T.StructType = schemas.WIRE_LOG, typed: T.StructType = schemas.LOG,
                value: str = "value", record: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, dirty rows): dirty text goes on unchanged in its own output. Other columns are carried along.

    ``typed`` names the declared members only. ``record`` names a column that keeps the whole text beside them.
    """
    parsed = _parsed(raw, wire, value)
    dirty = parsed.where(~_is_good()).drop("_r")
    return _typed(parsed.where(_is_good()), wire, typed, value, record), dirty


#: Column with the text of a dirty row in ``with_dirty``; null for records.
DIRTY = "dirty"


def with_dirty(raw: DataFrame, wire: T.StructType = schemas.WIRE_LOG, typed: T.StructType = schemas.LOG,
               value: str = "value", record: str | None = None) -> DataFrame:
    """All rows in one DataFrame: records with ``dirty`` null, and dirty rows whose text is in ``dirty`` and whose other
    fields are null. ``logs.split_tagged`` gives them an output of their own, in the same pass as the records."""
    parsed = _parsed(raw, wire, value)
    good = _is_good()
    rows = parsed.select(*[c for c in parsed.columns if c not in (value, "_r")], F.when(good, F.col(value)).alias(value),
                         F.when(~good, F.col(value)).alias(DIRTY), F.when(good, F.col("_r")).alias("_r"))
    return _typed(rows, wire, typed, value, record)


def drop_bad(raw: DataFrame, wire: T.StructType = schemas.WIRE_LOG, typed: T.StructType = schemas.LOG,
             value: str = "value", record: str | None = None) -> DataFrame:
    """Records only; text that cannot be parsed is left out silently."""
    return split_dirty(raw, wire, typed, value, record)[0]


def strict(raw: DataFrame, wire: T.StructType = schemas.WIRE_LOG, typed: T.StructType = schemas.LOG,
           value: str = "value") -> DataFrame:
    """Records; text that cannot be parsed fails the job."""
    parsed = raw.withColumn("_r", F.from_json(value, wire, {"mode": "FAILFAST"}))
    return _typed(parsed, wire, typed, value)
