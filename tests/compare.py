"""Row-by-row comparison of a Spark query with its SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb

from rimstone.gallery.base import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def compare(con, df, sql: str) -> tuple[int, list[str]]:
    """Row count and the differences found."""
    faults = []
    relation = con.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return 0, [f"columns {sorted(df.columns)} against {sorted(relation.columns)}"]
    order = sorted(df.columns)
    mine = Counter(tuple(plain(r[c]) for c in order) for r in df.select(*[f"`{c}`" for c in order]).collect())
    at = [relation.columns.index(c) for c in order]
    theirs = Counter(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    spark_types = {n: t for n, t in df.dtypes}
    same = {
        "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "smallint": "SMALLINT",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    for c, i in zip(order, at, strict=True):
        if same.get(spark_types[c]) != str(relation.types[i]):
            faults.append(f"type of {c}: {spark_types[c]} against {relation.types[i]}")
    if mine != theirs:
        faults.append(f"{sum(mine.values())} rows against {sum(theirs.values())}; columns {order}")
        faults += [f"only in spark: {x}" for x in list((mine - theirs).items())[:3]]
        faults += [f"only in sql: {x}" for x in list((theirs - mine).items())[:3]]
    return sum(mine.values()), faults
