"""Compare every registered query with its SQL on one scale: ``python -m checks.compare DIR``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracles import all_oracles
from checks.queries import all_queries
from orgkin.session import local_session

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(v):
    if v is None or v != v:
        return None
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, bool):
        return v
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows), key=repr
    )


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def main(sf_dir: str, only: list[str]) -> int:
    spark, con, failed = local_session(8), connect(sf_dir), 0
    sql = all_oracles()
    for name, query in all_queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        try:
            t0 = time.time()
            df = query(spark, sf_dir)
            got = _rows(df.columns, [tuple(r) for r in df.collect()])
            t1 = time.time()
            if name not in sql:
                print(f"rows  {name} {len(got[1])} {t1 - t0:.1f}s", flush=True)
                continue
            cur = con.execute(sql[name])
            want = _rows([d[0] for d in cur.description], cur.fetchall())
            t2 = time.time()
        except Exception as e:  # report and go on with the next query
            failed += 1
            print(f"ERROR {name} {str(e)[:900]}", flush=True)
            continue
        same = got == want
        failed += not same
        print(f"{'ok   ' if same else 'DIFF '} {name} {len(got[1])} "
              f"spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s", flush=True)
        if not same:
            print("  columns", got[0] == want[0], got[0], want[0] if got[0] != want[0] else "")
            print("  rows", len(got[1]), len(want[1]))
            shown = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]
            for a, b in shown:
                cells = [(c, x, y) for c, x, y in zip(got[0], a, b) if x != y]
                print("  ", str(cells)[:700], "|", str(a)[:200])
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
