"""Compare a query with its SQL on DuckDB: columns, row count and values in any order."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value):.14g}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the DataFrame and the SQL; nothing if they agree."""
    cursor = con.execute(sql)
    want_columns = [column[0] for column in cursor.description]
    want = canonical_rows(want_columns, cursor.fetchall())
    got = canonical_rows(df.columns, df.collect())
    found = []
    if sorted(df.columns) != sorted(want_columns):
        found.append(f"columns {sorted(df.columns)} != {sorted(want_columns)}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    if not found and got != want:
        wrong = [(a, b) for a, b in zip(got, want) if a != b]
        found.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    numeric = {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "DOUBLE", "DECIMAL"}
    names = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    want_types = {c[0]: str(c[1]).split("(")[0] for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in df.dtypes:
        expected = want_types.get(name)
        if expected and names.get(kind, kind) != expected and not (
            names.get(kind) in {"INTEGER", "BIGINT"} and expected in {"INTEGER", "BIGINT"}
        ):
            if not (expected in numeric and kind in {"int", "bigint"} and expected != "DOUBLE"):
                found.append(f"type of {name}: {kind} against {expected}")
    return found
