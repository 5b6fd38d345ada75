"""Runs a registered query and its SQL twin on the same tables and compares schema and rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return value


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences as text; empty if equal."""
    cur = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cur.description]
    expected = cur.fetchall()
    cols = sorted(spark_df.columns)
    problems = []
    duck_cols = sorted(n for n, _ in described)
    if cols != duck_cols:
        return [f"columns {cols} != {duck_cols}"]
    duck_types = dict(described)
    for name, dtype in spark_df.dtypes:
        want = TYPES.get(dtype, dtype)
        if want != duck_types[name]:
            problems.append(f"type of {name}: {dtype} vs {duck_types[name]}")
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in spark_df.select(*[f"`{c}`" for c in cols]).collect())
    position = {n: i for i, (n, _) in enumerate(described)}
    want_rows = Counter(tuple(_norm(row[position[c]]) for c in cols) for row in expected)
    if got != want_rows:
        extra, missing = got - want_rows, want_rows - got
        problems.append(
            f"rows {sum(got.values())} vs {sum(want_rows.values())}; only spark {sum(extra.values())}: {list(extra)[:2]}; "
            f"only sql {sum(missing.values())}: {list(missing)[:2]}"
        )
    if not want_rows:
        problems.append("no rows")
    return problems
