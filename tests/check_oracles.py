"""Run every registered query beside its SQL counterpart: python tests/check_oracles.py [folder] [name...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from lakecare.session import build_session  # noqa: E402
from tests.compare import connect, difference  # noqa: E402


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = build_session("oracle-check", "local[8]", spark__ui__enabled="false", spark__driver__memory="8g", **dict(a.split("=") for a in os.environ.get("CHECK_CONF", "").split()))
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(folder), entry.oracle_sql(), 0
    for name in chosen:
        started = time.time()
        try:
            df = entry.queries()[name](spark, folder)
            outcome = difference(df, con, oracle[name]) if name in oracle else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {' | '.join(str(error).splitlines())[:500]}"
        bad += outcome is not None and not outcome.startswith("rows only")
        print(f"{name:40s} {time.time() - started:6.1f}s {outcome or 'ok'}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
