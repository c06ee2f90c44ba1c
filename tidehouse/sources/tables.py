"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, name_or_path: str, fmt: str | None = None, **options: str) -> DataFrame:
    """Whole table: a catalog table by name, or files of format ``fmt`` (``parquet``, ``json``, ``jdbc``, ...)."""
    if fmt is None:
        return spark.read.table(name_or_path)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=name_or_path, **options).load()
    return spark.read.format(fmt).options(**options).load(name_or_path)


def lookup_rows(df: DataFrame, *pairs: tuple[str, object], **equals: object) -> DataFrame:
    """Rows where every named column equals its value. The predicates reach the scan of a columnar or JDBC source."""
    for name, value in [*pairs, *equals.items()]:
        df = df.where(F.col(name) == F.lit(value))
    return df
