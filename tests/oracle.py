"""Compare a Spark result with DuckDB's answer, ignoring row and column order."""

from __future__ import annotations

import os
import sys

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return connection


def canonical(table) -> pd.DataFrame:
    def text(value):
        return "NULL" if value is None else repr(value)

    columns = sorted(table.column_names)
    df = pd.DataFrame({c: [text(v) for v in table[c].to_pylist()] for c in columns})
    return df.sort_values(columns).reset_index(drop=True)


def kinds(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def differences(spark_df, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    ours = spark_df.toArrow()
    theirs = connection.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} vs {sorted(theirs.column_names)}"
    if kinds(ours) != kinds(theirs):
        a, b = kinds(ours), kinds(theirs)
        return f"types {({c: (a[c], b[c]) for c in a if a[c] != b[c]})}"
    if ours.num_rows != theirs.num_rows:
        return f"rows {ours.num_rows} vs {theirs.num_rows}"
    if ours.num_rows == 0:
        return "no rows on either side"
    left = canonical(ours)
    right = canonical(theirs)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ\n{left[unequal].head(4)}\n{right[unequal].head(4)}"
    return None


if __name__ == "__main__":
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from millrace.plans.registry import oracle_sql, queries
    from millrace.session import build_session

    folder = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    session = build_session("check", 8)
    duck = connect(folder)
    sqls, bad = oracle_sql(), 0
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        begin = time.time()
        try:
            if name in sqls:
                verdict = differences(run(session, folder), duck, sqls[name])
            else:
                verdict = None if run(session, folder).count() > 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += verdict is not None
        print(f"{time.time() - begin:6.2f}s {name:32s} {'ok' if verdict is None else verdict}", flush=True)
    print("failed:", bad)
