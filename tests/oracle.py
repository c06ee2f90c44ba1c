"""Compare a registered query with its SQL, value by value and regardless of row order."""

from __future__ import annotations

import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _sorted_rows([d[0] for d in result.description], result.fetchall())


def difference(df, con, sql, show: int = 3) -> str | None:
    have_columns, have = spark_rows(df)
    want_columns, want = sql_rows(con, sql)
    if have_columns != want_columns:
        return f"columns {have_columns} != {want_columns}"
    if have == want:
        return None
    extra, missing = set(have) - set(want), set(want) - set(have)
    return f"{len(have)} rows against {len(want)}; only here {list(extra)[:show]}; only there {list(missing)[:show]}"
