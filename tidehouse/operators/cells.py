"""Versioned cells in long form: ``row, family, qualifier, value, ts, type``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidehouse import schemas, sized

# Kinds of cell records.
PUT, DELETE, DELETE_COLUMN, DELETE_FAMILY = "Put", "Delete", "DeleteColumn", "DeleteFamily"

_CELL = ["row", "family", "qualifier"]


def put(rows: DataFrame, at_ms: Column | None = None) -> DataFrame:
    """Cells to append: a new version of each ``(row, family, qualifier, value)``. ``at_ms`` defaults to now."""
    ts = F.unix_millis(F.current_timestamp()) if at_ms is None else at_ms
    return rows.select(*_CELL, "value", ts.cast("bigint").alias("ts"), F.lit(PUT).alias("type"))


def delete(rows: DataFrame, kind: str = DELETE_FAMILY, at_ms: Column | None = None) -> DataFrame:
    """Tombstones to append. ``rows`` names row and family, and the qualifier for the column kinds.

    ``DeleteFamily`` hides a family, ``DeleteColumn`` all versions of a column, ``Delete`` the version of exactly that
    time (see ``latest_versions`` for the time of the latest one). A whole row is deleted by one tombstone per family.
    """
    if kind not in (DELETE, DELETE_COLUMN, DELETE_FAMILY):
        raise ValueError(f"unknown kind {kind!r}")
    ts = F.unix_millis(F.current_timestamp()) if at_ms is None else at_ms
    qualifier = F.lit(None).cast("string") if kind == DELETE_FAMILY else F.col("qualifier")
    return rows.select("row", "family", qualifier.alias("qualifier"), F.lit(None).cast("string").alias("value"),
                       ts.cast("bigint").alias("ts"), F.lit(kind).alias("type"))


def _range(cells: DataFrame, start: str | None, stop: str | None) -> DataFrame:
    if start is not None:
        cells = cells.where(F.col("row") >= start)
    if stop is not None:
        cells = cells.where(F.col("row") < stop)
    return cells.select(*schemas.CELL.fieldNames())


def _newest(cells: DataFrame, versions: int) -> DataFrame:
    newest = Window.partitionBy(*_CELL).orderBy(F.col("ts").desc(), F.col("value").desc_nulls_last())
    return cells.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= versions).drop("_rank")


def _live(cells: DataFrame, versions: int) -> DataFrame:
    """Newest puts that no tombstone hides.

    Family and column tombstones hide everything up to their time, so the newest versions can be picked before they are
    applied: the pick works on the map side and leaves few rows to join. Tombstones of single versions come first.
    All tombstones are reduced to unique keys before they meet the puts; AQE splits a row with very many cells.
    """
    gone = cells.where(F.col("type") != PUT)
    family = gone.where(F.col("type") == DELETE_FAMILY).groupBy("row", "family").agg(F.max("ts").alias("_family_ts"))
    column = gone.where(F.col("type") == DELETE_COLUMN).groupBy(*_CELL).agg(F.max("ts").alias("_column_ts"))
    version = gone.where(F.col("type") == DELETE).select(*_CELL, "ts").distinct()
    puts = cells.where(F.col("type") == PUT).join(version, [*_CELL, "ts"], "left_anti")
    shown = _newest(puts, versions).join(column, _CELL, "left").join(
        sized.splittable(family, "row", "family"), ["row", "family"], "left")
    is_live = [F.coalesce(F.col("ts") > F.col(when), F.lit(True)) for when in ("_column_ts", "_family_ts")]
    return shown.where(is_live[0] & is_live[1]).select(*schemas.CELL.fieldNames())


def scan(cells: DataFrame, start: str | None = None, stop: str | None = None, versions: int = 1,
         raw: bool = False) -> DataFrame:
    """Cells of the rows in ``[start, stop)``, up to ``versions`` newest versions of each column.

    ``raw`` shows what tombstones hide, and all tombstones of the range; only puts count as versions. The row range
    reaches the scan of a stored table. Records of one column and instant are ordered by value.
    """
    cells = _range(cells, start, stop)
    if not raw:
        return _live(cells, versions)
    return _newest(cells.where(F.col("type") == PUT), versions).unionByName(cells.where(F.col("type") != PUT))


def latest(cells: DataFrame, row: str | None = None) -> DataFrame:
    """Latest live version of every cell, of one row or of all rows."""
    if row is not None:
        cells = cells.where(F.col("row") == row)
    return scan(cells)


def delete_latest(cells: DataFrame, rows: DataFrame) -> DataFrame:
    """Tombstones for the latest live version of the given columns ``(row, family, qualifier)``."""
    newest = scan(cells).join(rows.select(*_CELL).distinct(), _CELL, "left_semi")
    return delete(newest, DELETE, F.col("ts"))
