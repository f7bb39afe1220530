"""Command line: ``python tests/run_oracle.py DATA_DIR [name ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry
from compare import compare, duck
from tallyward.session import build_session

if __name__ == "__main__":
    data, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(data)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        built = ran = 0.0
        try:
            df = queries[name](spark, data)
            built = time.time() - start
            df.write.format("noop").mode("overwrite").save()
            ran = time.time() - start
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                n = len(df.collect())
                problems = [] if n else ["no rows"]
        except Exception as err:  # report and go on
            problems = [f"{type(err).__name__}: {str(err)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} build {built:5.2f} spark {ran:6.2f} total {time.time() - start:6.2f}", "" if name in oracles else "(rows only)", flush=True)
        for p in problems:
            print("    ", p)
    print(f"{bad} failing of {len(names or queries)}")
