"""Runs a registered query on Spark and its SQL on DuckDB, and says how the results differ."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(table):
    columns = sorted(table.column_names)
    return columns, {c: str(table.schema.field(c).type) for c in columns}, Counter(
        tuple(repr(v) for v in row) for row in zip(*[table.column(c).to_pylist() for c in columns])
    )


def _plain(kind: str) -> str:
    return kind.replace("large_string", "string").replace("element", "l").replace("child", "l").replace(" not null", "")


def differences(entry, spark, folder, con=None) -> list[str]:
    con = con or connect(folder)
    ours = entry(spark, folder).toArrow()
    theirs = con.execute(entry.sql).to_arrow_table()
    cols_a, types_a, rows_a = _rows(ours)
    cols_b, types_b, rows_b = _rows(theirs)
    found = []
    if cols_a != cols_b:
        return [f"columns {cols_a} against {cols_b}"]
    for c in cols_a:
        if _plain(types_a[c]) != _plain(types_b[c]):
            found.append(f"type of {c}: {types_a[c]} against {types_b[c]}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"{ours.num_rows} rows against {theirs.num_rows}")
    if rows_a != rows_b:
        found.append(f"only Spark {list((rows_a - rows_b).items())[:3]}; only SQL {list((rows_b - rows_a).items())[:3]}")
    if theirs.num_rows == 0:
        found.append("no rows")
    return found
