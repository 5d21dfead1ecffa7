"""Run a query in Spark and its SQL in DuckDB and compare them strictly."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(directory):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def compare(frame, con, sql):
    """None when columns, types and all rows agree, else what differs first."""
    cursor = con.execute(sql)
    types = {d[0]: _TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    names = sorted(types)
    ours = dict(frame.dtypes)
    if sorted(ours) != names:
        return f"columns {sorted(ours)} against {names}"
    wrong = {n: (ours[n], types[n]) for n in names if ours[n] != types[n]}
    if wrong:
        return f"types {wrong}"
    place = [list(types).index(n) for n in names]
    expected = sorted((tuple(r[i] for i in place) for r in cursor.fetchall()), key=_key)
    got = sorted((tuple(r) for r in frame.select(*names).collect()), key=_key)
    if len(expected) != len(got):
        return f"{len(got)} rows against {len(expected)}: {got[:3]} against {expected[:3]}"
    for a, b in zip(got, expected):
        if a != b and not all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b)
        ):
            return f"row {a} against {b}"
    return None
