"""Run registered queries against their oracles: python -m tests.oracle_check [names...]."""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(df, con, sql: str) -> str | None:
    """None if both sides hold the same rows, else a description of the difference."""
    con.register("ours", df.toArrow())
    con.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {sql}")
    expected = sorted(c[0] for c in con.execute("DESCRIBE theirs").fetchall())
    if sorted(df.columns) != expected:
        return f"columns {sorted(df.columns)} vs {expected}"
    columns = ", ".join(f'"{c}"' for c in expected)
    missing, extra = (
        con.execute(f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b}").fetchall()
        for a, b in (("theirs", "ours"), ("ours", "theirs")))
    if not missing and not extra:
        return None
    lines = [f"{len(extra)} unexpected, {len(missing)} missing: {columns}"]
    lines += [f"  spark {r}" for r in sorted(extra, key=str)[:3]]
    lines += [f"  duck  {r}" for r in sorted(missing, key=str)[:3]]
    return "\n".join(lines)


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from lotwise.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(8), connect(sf_dir)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"rows {df.count()} (no oracle)"
        except Exception as e:  # report and go on with the other queries
            problem = f"{type(e).__name__}: {str(e)[:400]}"
        if problem and "no oracle" not in problem:
            bad += 1
        print(f"{'ok  ' if not problem else '    '}{name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
