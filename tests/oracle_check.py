"""Run registered queries against the SQL oracle and report differences.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def norm(value):
    if isinstance(value, bool) or value is None:
        return (value is None, "bool", str(value))
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return (False, "num", "nan" if math.isnan(number) else repr(number))
    if isinstance(value, (datetime, date)):
        return (False, "time", value.isoformat())
    return (False, "text", str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a description of the first differences."""
    df = fn(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(mine[1])
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}", len(mine[1])
    if mine[1] == theirs[1]:
        return None, len(mine[1])
    left, right = set(mine[1]), set(theirs[1])
    return f"{len(mine[1])} rows against {len(theirs[1])}; only here {sorted(left - right)[:3]}; only there {sorted(right - left)[:3]}", len(mine[1])


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, fn in contract.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as error:  # report and go on
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad, "without oracle:", sorted(set(contract.queries()) - set(sqls)))


if __name__ == "__main__":
    main()
