"""Compare every query with its SQL: ``python -m checks.run <table folder> [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback

from checks.compare import connect, differences
from checks.registry import queries
from checks.sql import oracles
from skyledger.session import build_session


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = build_session("checks", {"spark.sql.shuffle.partitions": "8"}, "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    connection, expected, failed = connect(sf_dir), oracles(), []
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            result = query(spark, sf_dir)
            if name in expected:
                verdict = differences(result, connection, expected[name])
            else:
                verdict = "" if result.count() else "no rows"
        except Exception:
            verdict = traceback.format_exc(limit=3)
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if not verdict else verdict}",
              flush=True)
        if verdict:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
