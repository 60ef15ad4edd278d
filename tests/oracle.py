"""Run a registered query and its SQL over the same tables and compare all values."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def compare(df, con, sql: str, timing: list | None = None) -> None:
    timing = [] if timing is None else timing
    start = time.time()
    rows = df.collect()
    timing.append(time.time() - start)
    found = con.execute(sql)
    expected_columns = [d[0] for d in found.description]
    expected_rows = found.fetchall()
    columns, got = _sorted_rows(df.columns, [tuple(r) for r in rows])
    wanted_columns, wanted = _sorted_rows(expected_columns, expected_rows)
    assert columns == wanted_columns
    assert len(got) == len(wanted), (len(got), len(wanted))
    assert got, "no rows"
    for a, b in zip(got, wanted):
        assert [type(x) for x in a if x is not None] == [type(x) for x in b if x is not None] and a == b, (columns, a, b)
