"""Compares named queries with their SQL: python tests/oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


def compare(spark, sf_dir: str, frame, sql: str) -> str:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}"
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    rel = con.sql(sql)
    want_columns = rel.columns
    want = rel.fetchall()
    got = frame.collect()
    if sorted(frame.columns) != sorted(want_columns):
        return f"columns {sorted(frame.columns)} != {sorted(want_columns)}"
    order = sorted(want_columns)
    a = Counter(tuple(norm(r[c]) for c in order) for r in got)
    b = Counter(tuple(norm(r[want_columns.index(c)]) for c in order) for r in want)
    if a == b:
        return ""
    return f"{len(got)} rows, SQL {len(want)}; only Spark {list((a - b).items())[:2]}; only SQL {list((b - a).items())[:2]}"


def session():
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session()
    bad = 0
    for name, f in e.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            frame = f(spark, sf)
            sql = e.oracle_sql().get(name)
            said = compare(spark, sf, frame, sql) if sql else f"(rows only) {frame.count()} rows"
        except Exception as x:
            said = f"ERROR {type(x).__name__} {str(x)[:700]}"
        bad += bool(said) and not said.startswith("(rows")
        print(f"{name}: {said or 'ok'} [{time.time() - began:.1f}s]", flush=True)
    print("bad:", bad)
