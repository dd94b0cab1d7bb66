"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.queries import ORACLES, QUERIES  # noqa: E402
from tidemark.queries.data import TABLES  # noqa: E402
from tidemark.session import local  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(tuple(str(r[i]) for i in order) for r in rows))


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLES[name])
    want_cols, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lost = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows against {len(want)}; only Spark {extra}; only SQL {lost}"
    return None


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    names = sys.argv[2:] or list(QUERIES)
    folder = f"/root/testdata/sf{sf}"
    session, connection = local(8), connect(folder)
    bad = 0
    for q in names:
        start = time.time()
        try:
            fault = compare(session, connection, q, folder) if q in ORACLES else (
                QUERIES[q](session, folder).count() and None)
        except Exception as error:
            fault = f"{type(error).__name__}: {str(error)[:600]}"
        bad += fault is not None
        print(f"{'ok  ' if fault is None else 'BAD '} {q:<28} {time.time() - start:6.2f}s  {fault or ''}",
              flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
