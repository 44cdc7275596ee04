"""Run registered queries and their SQL checks side by side: ``python tests/compare.py sf0.01 [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v: object) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    return str(v)


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str:
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows {len(got)}"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, cur.fetchall())
    if got == want:
        return f"ok {len(got)}" if got else "EMPTY"
    a, b = set(got), set(want)
    return f"DIFF {len(got)} != {len(want)}; only spark {list(a - b)[:3]}; only sql {list(b - a)[:3]}; columns {sorted(names)}"


def main() -> None:
    import __spark_entry__ as entry
    from waferline.session import local_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    spark = local_session(8)
    con = connect(sf_dir)
    checks = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if sys.argv[2:] and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        start = time.time()
        try:
            result = compare(spark, con, name, fn, checks.get(name), sf_dir)
        except Exception as e:  # keep going, report at the end
            result = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        bad += not result.startswith(("ok", "rows"))
        print(f"{name:28s} {time.time() - start:6.2f}s {result[:1200]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
