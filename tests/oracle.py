"""Runs a query and its SQL on the same tables and compares the results."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = os.environ.get("TIDEMARK_TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(r[n]) for n in names) for r in df.collect()]


def sql_rows(con, text):
    cursor = con.execute(text)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]


def differences(df, con, text) -> str | None:
    """None if names, row count and values agree; floats must be the same to 1e-9."""
    names, got = spark_rows(df)
    wanted_names, wanted = sql_rows(con, text)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    exact = 0
    for a, b in zip(sorted(got, key=_key), sorted(wanted, key=_key)):
        for name, x, y in zip(names, a, b):
            if type(x) is not type(y) and not (isinstance(x, (int, float)) and isinstance(y, (int, float))):
                return f"{name}: {x!r} ({type(x)}) != {y!r} ({type(y)})"
            if isinstance(x, float) and isinstance(y, float) and x != y:
                exact += 1
                if not math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9):
                    return f"{name}: {x!r} != {y!r} in {a} / {b}"
            elif x != y:
                return f"{name}: {x!r} != {y!r} in {a} / {b}"
    return f"close but not equal: {exact} values" if exact else None
