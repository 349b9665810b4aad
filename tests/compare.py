"""Run registered queries in Spark and DuckDB and compare the results.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from wattspindle.plans.catalog import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value) -> str:
    if value is None or value is pd.NA or value is pd.NaT:
        return "∅"
    if isinstance(value, float):
        return "∅" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df: DataFrame) -> tuple[list[str], list]:
    return df.columns, [tuple(row) for row in df.collect()]


def differences(spark: SparkSession, con, sf_dir: str, build, sql: str) -> list[str]:
    """Empty when the columns and all rows agree."""
    left_columns, left_rows = spark_rows(build(spark, sf_dir))
    result = con.execute(sql)
    right_columns = [d[0] for d in result.description]
    right_rows = result.fetchall()
    if sorted(left_columns) != sorted(right_columns):
        return [f"columns {sorted(left_columns)} != {sorted(right_columns)}"]
    left = canonical(left_columns, left_rows)
    right = canonical(right_columns, right_rows)
    if left == right:
        return []
    only_left, only_right = set(left) - set(right), set(right) - set(left)
    return [
        f"rows {len(left)} / {len(right)}, only spark {len(only_left)}, only sql {len(only_right)}",
        f"columns {sorted(left_columns)}",
        *[f"spark {row}" for row in sorted(only_left)[:3]],
        *[f"sql   {row}" for row in sorted(only_right)[:3]],
    ]


def main() -> int:
    import __spark_entry__ as entry
    from wattspindle.session import create_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = create_session("compare", cores=8)
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name, build in queries.items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            found = differences(spark, con, sf_dir, build, oracles[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - began:.2f}s", flush=True)
        for line in found:
            print("     ", line, flush=True)
        if found:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
