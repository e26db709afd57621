"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

    python scripts/check_oracle.py [sf_dir] [name ...]

Comparison: same column names, same row count, and the same multiset of rows
after sorting columns by name (doubles compared to 1e-9 relative).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from sampwise.plans.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from sampwise.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE_SQL[name])
    o_rows = rel.fetchall()
    s_cols, s_norm = normalise(df.columns, s_rows)
    o_cols, o_norm = normalise(list(rel.columns), o_rows)
    if s_cols != o_cols:
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    if len(s_norm) != len(o_norm):
        return False, f"row count differs: spark={len(s_norm)} oracle={len(o_norm)}"
    if s_norm != o_norm:
        bad = next(i for i, (a, b) in enumerate(zip(s_norm, o_norm)) if a != b)
        return False, f"values differ at {bad}: spark={s_norm[bad]} oracle={o_norm[bad]}"
    return True, f"{len(s_norm)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(ORACLE_SQL)
    from sampwise.session import local_session
    spark = local_session(8, 8)
    con = duck(sf_dir)
    failed = 0
    for name in names:
        t = time.time()
        try:
            ok, msg = compare(spark, con, name, sf_dir)
        except Exception as exc:  # report and go on
            ok, msg = False, f"{type(exc).__name__}: {str(exc).splitlines()[0][:300]}"
        failed += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.2f}s  {msg}", flush=True)
    print(f"{len(names) - failed}/{len(names)} match")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
