"""Run registered queries against their SQL: python tests/check_queries.py [dir] [name ...]"""

import os
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1]
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    names = [q for n in names for q in queries if (q.startswith(n[:-1]) if n.endswith("*") else q == n)]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    if "HOT_ROWS" in os.environ:
        conf["spark.tidemark.hotRows"] = os.environ["HOT_ROWS"]
    spark = build_session("check", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), []
    for name in names:
        began = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                why = compare(df, con, oracles[name])
                rows = ""
            else:
                n = len(df.collect())
                why, rows = None if n else "no rows", f" ({n} rows, no SQL)"
        except Exception as e:
            why, rows = "".join(traceback.format_exception_only(e))[:900], ""
        print(f"{'ok ' if why is None else 'BAD'} {name} {time.time() - began:.1f}s{rows} {why or ''}", flush=True)
        if why:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} ok; bad: {bad}")


main()
