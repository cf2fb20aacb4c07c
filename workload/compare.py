"""Run queries against their oracles: ``python -m workload.compare SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(round(value, 6))
    return str(value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else a short description."""
    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    names, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = _bag(df.columns, got), _bag(names, want)
    if left == right:
        return None
    a, b = set(left), set(right)
    return f"{len(left)} vs {len(right)} rows; only ours {sorted(a - b)[:3]}; only oracle {sorted(b - a)[:3]}"


def main() -> None:
    from workload.queries import QUERIES
    from workload.session import local_session

    spark = local_session()
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff = difference(spark, con, name, sf_dir)
        except Exception as exc:
            diff = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += diff is not None
        print(f"{name:28s} {time.time() - start:6.2f} {'ok' if diff is None else diff}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")


if __name__ == "__main__":
    main()
