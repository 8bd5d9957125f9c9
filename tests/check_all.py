"""Run every registered query against its SQL: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E
from oracle import connect, differences

from kilospan.session import local_session


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark, con = local_session(8), connect(sf_dir)
    sql, bad = E.oracle_sql(), []
    for name, fn in E.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in sql:
                note = ["(rows only)"] if len(got) else ["EMPTY"]
            else:
                want = con.execute(sql[name]).df()
                note = differences(got, want) or ([] if len(got) else ["EMPTY"])
        except Exception as e:
            took, got, note = time.time() - start, [], [f"ERROR {type(e).__name__} {str(e)[:600]}"]
        if note and note != ["(rows only)"]:
            bad.append(name)
        print(f"{name:28s} {len(got):7d} rows {took:6.2f}s {'; '.join(note) or 'ok'}", flush=True)
    print("FAILED:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
