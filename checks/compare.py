"""Run registered queries beside their SQL and report differences."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result, as readable lines."""
    columns = sorted(df.columns)
    got = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    found = con.execute(sql)
    heads = {d[0]: str(d[1]) for d in found.description}
    rows = found.fetchall()
    if sorted(heads) != columns:
        return [f"columns {columns} vs {sorted(heads)}"]
    at = [list(heads).index(c) for c in columns]
    want = [tuple(_plain(r[i]) for i in at) for r in rows]
    out = []
    for c, kind in df.dtypes:
        if TYPES.get(kind, kind) != heads[c]:
            out.append(f"type of {c}: {kind} vs {heads[c]}")
    a, b = sorted(got, key=repr), sorted(want, key=repr)
    if a != b:
        left, right = [x for x in a if x not in set(b)], [x for x in b if x not in set(a)]
        out.append(f"rows {len(a)} vs {len(b)}; only spark {left[:3]}; only sql {right[:3]}")
    return out
