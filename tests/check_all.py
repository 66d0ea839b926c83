"""Run every registered query against its SQL: python -m tests.check_all [folder] [name ...]"""

import sys
import time

import __spark_entry__ as entry
from duskwork.session import local_session
from tests.oracle import compare, connect

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con = local_session("check"), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if (names and name not in names) or name not in oracle:
            continue
        start = time.time()
        try:
            problem, count = compare(run(spark, folder), con, oracle[name])
        except Exception as error:  # noqa: BLE001
            problem, count = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={count} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} problems")
    spark.stop()
