"""Run queries against their SQL: ``python tests/check_all.py [sf folder] [name prefix ...]``."""

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/", 2)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

import __spark_entry__ as e
from compare import differences, duck, duck_side, spark_side
from tidemark.session import build_session


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = build_session("check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(folder), e.oracle_sql(), []
    for name, fn in e.queries().items():
        if not name.startswith(prefixes):
            continue
        begun = time.time()
        try:
            got = spark_side(fn(spark, folder))
            took = time.time() - begun
            diff = differences(got, duck_side(con, oracles[name])) if name in oracles else ["no sql"]
        except Exception as error:
            took, diff = time.time() - begun, [f"{type(error).__name__}: {str(error)[:600]}"]
            if "-v" in sys.argv:
                traceback.print_exc()
        status = "ok  " if not diff else "FAIL"
        print(f"{status} {name} {took:.1f}s {sum(got[1].values()) if not diff else ''} {' | '.join(diff)}", flush=True)
        if diff:
            bad.append(name)
    print("bad:", bad)
    spark.stop()


main()
