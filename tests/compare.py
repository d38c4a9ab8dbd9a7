"""Run the catalog next to DuckDB and compare whole results.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}") + 0.0
    return str(value) if hasattr(value, "isoformat") else value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def difference(spark, con, name: str, folder: str) -> str:
    """Empty if the two results agree, else what differs first."""
    df = queries()[name](spark, folder)
    got_columns, got = normal(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(oracle_sql()[name])
    want_columns, want = normal([c[0] for c in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} against {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows, first {bad[0][0]} against {bad[0][1]}" if bad else ""


def main() -> None:
    from tests.conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, con, failed = make_session(), connect(folder), []
    for name in names:
        start = time.time()
        try:
            if name in oracle_sql():
                problem = difference(spark, con, name, folder)
                note = problem or "ok"
            else:
                problem, note = "", f"rows only: {len(queries()[name](spark, folder).collect())}"
        except Exception as error:  # noqa: BLE001
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += [name] if problem else []
        spark.catalog.clearCache()
        print(f"{name:32s} {time.time() - start:6.2f}s  {note}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
