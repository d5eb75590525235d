"""python tests/run_oracle.py SF_DIR [key ...]: compare queries with their oracles, timed."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from playmart.session import local_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    runs, sqls = entry.queries(), entry.oracle_sql()
    orders = {key: query.order for key, query in entry.warehouse().items()}
    db, bad = connect(sf_dir), 0
    for key in keys or sqls:
        start = time.time()
        try:
            problem, n = compare(runs[key](spark, sf_dir), db, sqls[key], orders.get(key, ()))
        except Exception:
            problem, n = traceback.format_exc()[-1500:], -1
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {time.time() - start:6.2f}s {key} {n} rows {problem}", flush=True)
    print("failures:", bad)
