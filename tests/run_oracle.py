"""Report for all queries (or those named): python tests/run_oracle.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

import __spark_entry__ as entry
from oracle import compare, connect
from pulseframe.session import get_spark

if __name__ == "__main__":
    sf_dir, names = (sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"), sys.argv[2:]
    spark = get_spark("oracle", master="local[8]", **{"spark__sql__shuffle__partitions": "8", "spark__ui__enabled": "false", "spark__driver__memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sql:
                timing = []
                compare(df, con, sql[name], timing)
                note = f"ok (query {timing[0]:.2f}s)"
            else:
                note = f"rows only: {df.count()}"
        except Exception as e:
            bad += 1
            note = "FAIL " + str(e).strip().replace("\n", " ")[:600]
        print(f"{name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", bad)
