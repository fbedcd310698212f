"""Compare registered queries with their DuckDB twins, cell by cell.

    python tests/oracle_check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def kind(value):
    if value is None:
        return None
    for types, name in (((bool,), "bool"), ((int,), "int"), ((float,), "float"), ((decimal.Decimal,), "decimal"),
                        ((datetime.datetime,), "datetime"), ((str,), "str")):
        if isinstance(value, types):
            return name
    return type(value).__name__


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def normalized(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    kinds = [sorted({kind(row[i]) for row in rows} - {None}) for i in order]
    return [names[i] for i in order], kinds, sorted(cells, key=repr)


def compare(spark_df, con, sql):
    """None when equal, else a short account of the first difference; and the row count."""
    left = normalized(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    right = normalized(names, cursor.fetchall())
    n = len(left[2])
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}", n
    if n != len(right[2]):
        return f"rows {n} != {len(right[2])}", n
    if left[1] != right[1]:
        return f"types {left[1]} != {right[1]}", n
    for a, b in zip(left[2], right[2]):
        if a != b:
            return f"first difference\n    spark  {str(a)[:400]}\n    duckdb {str(b)[:400]}", n
    return None, n


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"

    import __spark_entry__ as entry
    from millrace.session import build_session

    spark = build_session("oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                         "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name in args.names or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem, n = compare(df, con, oracles[name])
            else:
                problem, n = None, len(df.collect())
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:5}{time.time() - started:7.2f}s {n:9} {name}" + (f"\n    {problem}" if problem else ""), flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
