"""Compare a registered query with its SQL text on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0  # -0.0 and 0.0 are one value
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda t: tuple((v is None, str(v)) for v in t)), [names[i] for i in order]


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns and rows (in any order), else what differs."""
    cursor = con.execute(sql)
    want, want_names = _sorted(cursor.fetchall(), [d[0] for d in cursor.description])
    got, got_names = _sorted([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None
