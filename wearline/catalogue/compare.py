"""Runs one registered query and its SQL twin and reports how they differ."""

from __future__ import annotations

import glob
import math
import os


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def difference(spark_df, con, statement: str) -> str | None:
    """None if columns, value types and values agree, else the first difference."""
    mine = spark_df.columns
    relation = con.sql(statement)
    theirs = relation.columns
    if sorted(mine) != sorted(theirs):
        return f"columns {sorted(mine)} against {sorted(theirs)}"
    order = sorted(mine)
    left = sorted((tuple(_plain(r[c]) for c in order) for r in spark_df.collect()), key=_key)
    index = [theirs.index(c) for c in order]
    right = sorted((tuple(_plain(r[i]) for i in index) for r in relation.fetchall()), key=_key)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{dict(zip(order, a))} against {dict(zip(order, b))}"
    return None
