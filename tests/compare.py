"""Side-by-side run of a Spark query and its DuckDB statement."""

from __future__ import annotations

import decimal
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and the bags of rows agree."""
    result = con.sql(sql)
    ours = sorted((n, _TYPES.get(t, t)) for n, t in df.dtypes)
    theirs = sorted(zip(result.columns, map(str, result.types)))
    found = [] if ours == theirs else [f"schema {ours} / {theirs}"]
    names = sorted(df.columns)
    if sorted(result.columns) != names:
        return found
    left = Counter(tuple(_value(r[n]) for n in names) for r in df.collect())
    order = [result.columns.index(n) for n in names]
    right = Counter(tuple(_value(r[i]) for i in order) for r in result.fetchall())
    if left != right:
        a, b = left - right, right - left
        found.append(
            f"rows {sum(left.values())} / {sum(right.values())}; only Spark {list(a)[:3]}; only DuckDB {list(b)[:3]}"
        )
    return found
