"""Run registered queries against their oracle SQL and compare whole results."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(r[i] for i in order) for r in map(tuple, rows)) \
        if not any(None in tuple(r) for r in rows) else sorted(
            (tuple(r[i] for i in order) for r in map(tuple, rows)),
            key=lambda r: tuple((x is None, str(x)) for x in r))


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short description of the first difference."""
    want = con.execute(sql)
    w_names, w_rows = _canonical([d[0] for d in want.description], want.fetchall())
    g_names, g_rows = _canonical(df.columns, df.collect())
    if w_names != g_names:
        return f"columns {g_names} instead of {w_names}"
    if len(w_rows) != len(g_rows):
        return f"{len(g_rows)} rows instead of {len(w_rows)}"
    for got, wanted in zip(g_rows, w_rows):
        if got != wanted or [type(x) for x in got] != [type(x) for x in wanted]:
            return f"{got} instead of {wanted}"
    return None
