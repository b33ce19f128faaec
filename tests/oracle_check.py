"""Compare registered queries with their SQL: ``python tests/oracle_check.py SF_DIR [name-prefix ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, bool) or value is None:
        return repr(value)
    return f"{float(value):.6g}" if type(value).__name__ == "Decimal" else str(value)


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(norm(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, q, allow_empty=False):
    """None when equal, else a short description of the difference."""
    df = q.build(spark, sf_dir)
    got = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    if q.sql is None:
        return None if got[1] else "no rows"
    result = con.execute(q.sql)
    want = normal_rows([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if not want[1] and not allow_empty:
        return "oracle is empty"
    types = {d[0]: str(d[1]) for d in result.description}
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        missing = [r for r in want[1] if r not in set(got[1])][:3]
        return f"rows {len(got[1])} vs {len(want[1])}; columns {got[0]}; extra {extra}; missing {missing}; {types}"
    return None


def main() -> int:
    from tidemark.catalog import REGISTRY
    from tidemark.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sys.argv[1])
    bad = 0
    for name, q in REGISTRY.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, q)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
