"""Run every registered query against its SQL twin: python tests/check_all.py [folder] [name ...]"""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from compare import connect, differences  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from netsift.session import build_session  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle = connect(folder), oracle_sql()
    names = sys.argv[2:] or list(queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, folder)
            problems = differences(df, connection, oracle[name]) if name in oracle else [f"rows only: {df.count()}"]
        except Exception as error:  # noqa: BLE001
            problems = [f"ERROR {type(error).__name__}: {str(error)[:600]}"]
        failed = bool(problems) and not problems[0].startswith("rows only")
        bad += failed
        print(f"{'BAD' if failed else 'ok '} {name:28s} {time.time() - start:6.2f}s {' '.join(problems)[:1200]}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
