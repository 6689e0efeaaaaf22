"""Runs registered queries against their SQL and reports differences.

``python tests/compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None when equal, else a message."""
    ours = [tuple(r) for r in df.collect()]
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = normalise(df.columns, ours), normalise(names, theirs.fetchall())
    if a == b:
        return None if a else "no rows"
    left, right = [r for r in a if r not in set(b)][:3], [r for r in b if r not in set(a)][:3]
    return f"rows {len(a)} vs {len(b)}\n   spark {left}\n   sql   {right}"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = difference(df, con, checks[name]) if name in checks else (None if df.count() else "no rows")
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        took = time.time() - start
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {took:6.2f}s {name}{'' if name in checks else ' (rows only)'}{'' if problem is None else ' ' + problem}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
