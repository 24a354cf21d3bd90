"""Run registered queries in Spark and DuckDB and compare them as bags of rows.

``python -m tests.agreement [folder] [key ...]``
"""

import math
import signal
import sys
import time

import duckdb

from workload.registry import TABLES


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}") + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([_cell(x) for x in v])
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(con, df, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    ours = df.collect()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = _bag(df.columns, ours), _bag(names, theirs)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}; first {a[:2]} / {b[:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ; {sorted(names)}: {bad[0][0]} / {bad[0][1]}"
    return None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = argv[0] if argv and "/" in argv[0] else "/root/testdata/sf0.01"
    keys = [k for k in argv if "/" not in k]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false") \
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle, failed = connect(folder), entry.queries(), entry.oracle_sql(), []

    def expired(*_):
        raise TimeoutError("took longer than 120 s")

    signal.signal(signal.SIGALRM, expired)
    for key in keys or queries:
        start = time.time()
        signal.alarm(120)
        try:
            df = queries[key](spark, folder)
            problem = compare(con, df, oracle[key]) if key in oracle else (None if df.count() else "no rows")
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        signal.alarm(0)
        n = "" if problem else ("" if key in oracle else "(rows only)")
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - start:.2f}s {problem or n}", flush=True)
        failed += [key] if problem else []
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
