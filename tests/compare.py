"""Run a registered query and its SQL on the same parquet files and compare whole results."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime) and v.time() == dt.time():
        return f"{v.date()} 00:00"
    return f"{type(v).__name__}:{v}"


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, query, sf_dir: str) -> tuple[int, str | None]:
    """(rows, None) when both sides agree, else (rows, what differs)."""
    df = query.spark(spark, sf_dir)
    ours = _canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = query.oracle()
    if sql is None:
        return len(ours[1]), None
    result = con.execute(sql)
    theirs = _canonical([c[0] for c in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return len(ours[1]), f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        left, right = set(ours[1]) - set(theirs[1]), set(theirs[1]) - set(ours[1])
        return len(ours[1]), (
            f"rows {len(ours[1])} != {len(theirs[1])}; spark only {len(left)}: {sorted(left)[:3]}; "
            f"sql only {len(right)}: {sorted(right)[:3]}"
        )
    return len(ours[1]), None
