"""Compares the registered queries with their SQL: python tests/comparison.py [folder] [name ...]"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# Spark type -> DuckDB types that count as the same
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"},
    "decimal(10,2)": {"DECIMAL(10,2)"},
}


# what no plan may hold: joins without keys, and Python per row or batch
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "MapPartitions")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _key(row):
    return tuple((value is not None, str(value) if isinstance(value, bool | Decimal) else value) for value in row)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_key)


def differences(spark, con, name, function, sql, folder, forbidden=FORBIDDEN) -> str | None:
    """None if the query and its SQL agree in columns, types, rows and values, and the plan is sound."""
    df = function(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [operator for operator in forbidden if operator in plan]
    if found:
        return f"plan has {found}"
    expected = con.sql(sql)
    types = dict(df.dtypes)
    expected_types = dict(zip(expected.columns, map(str, expected.types)))
    if set(types) != set(expected_types):
        return f"columns {sorted(set(types) ^ set(expected_types))}"
    wrong = {c: (t, expected_types[c]) for c, t in types.items() if expected_types[c] not in SAME_TYPE.get(t, ())}
    if wrong:
        return f"types {wrong}"
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    want = _rows(expected.fetchall(), expected.columns)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            pairs = zip(sorted(df.columns), mine, theirs)
            return f"values {[p for p in pairs if p[1] != p[2]]} in {mine}"
    return None if got else "no rows"


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from moonstride.catalog import registered
    from moonstride.session import build_session

    spark = build_session("comparison", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), oracle_sql(), 0
    plain = registered()
    for name, function in queries().items():
        if name not in sql or names and name not in names:
            continue
        start = time.time()
        try:
            forbidden = FORBIDDEN if name in plain else FORBIDDEN[:2]
            found = differences(spark, con, name, function, sql[name], folder, forbidden)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    sys.exit(main(folder, sys.argv[2:]) > 0)
