"""Runs a registered query on Spark and its reference SQL on DuckDB and compares the rows."""

import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from surveyloom.plans.holding import release_all  # noqa: E402


def connect(directory: str):
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, int):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(canonical(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(spark, name, directory):
    df = contract.queries()[name](spark, directory)
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, name):
    cur = con.execute(contract.oracle_sql()[name])
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def main(directory, names):
    from surveyloom.plans.session import local_session
    spark = local_session()
    con = connect(directory)
    bad = []
    for name in names or contract.queries():
        start = time.time()
        try:
            columns, rows = spark_rows(spark, name, directory)
            took = time.time() - start
            if name not in contract.oracle_sql():
                print(f"rows  {name:24s} {len(rows):7d} {took:6.2f}s {rows[:2] if names else ''}", flush=True)
                continue
            expected_columns, expected = oracle_rows(con, name)
            ok = columns == expected_columns and rows == expected
            print(f"{'ok   ' if ok else 'DIFF '} {name:24s} {len(rows):7d} {took:6.2f}s oracle {time.time() - start - took:.2f}s", flush=True)
            if not ok:
                bad.append(name)
                print("   ", columns, "|", expected_columns, len(rows), len(expected))
                shown = 0
                for a, b in zip(rows, expected):
                    if a != b:
                        print("    spark ", str(a)[:300], "\n    oracle", str(b)[:300])
                        shown += 1
                        if shown == 3:
                            break
        except Exception as e:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL  {name}: {type(e).__name__}: {str(e)[:700]}", flush=True)
        finally:
            release_all()
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
