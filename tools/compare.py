"""Compare registered queries with their SQL in DuckDB: row count, column names, values.

    python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tickharbor import build_session  # noqa: E402
from tickharbor.plans import oracle_sql, queries  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def normal(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return connection


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--cpus", default="8")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(master=f"local[{args.cpus}]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, expected, failed = connect(args.sf), oracle_sql(), []
    for name, run in queries().items():
        if args.names and not any(part in name for part in args.names):
            continue
        started = time.time()
        try:
            df = run(spark, args.sf)
            columns, rows = table(df.columns, df.collect())
            seconds = time.time() - started
            if name not in expected:
                print(f"rows  {name}: {len(rows)} rows, {seconds:.2f} s", flush=True)
                continue
            result = connection.sql(expected[name])
            other_columns, other = table(result.columns, result.fetchall())
        except Exception as error:  # noqa: BLE001
            failed.append(name)
            print(f"FAIL  {name}: {str(error)[:1500]}", flush=True)
            continue
        if columns == other_columns and rows == other:
            kinds = dict(df.dtypes), {c: str(t) for c, t in zip(result.columns, result.types, strict=True)}
            odd = {c: (k, kinds[1][c]) for c, k in kinds[0].items() if (k, kinds[1][c]) not in SAME_TYPES}
            print(f"ok    {name}: {len(rows)} rows, {seconds:.2f} s{' types ' + str(odd) if odd else ''}", flush=True)
            continue
        failed.append(name)
        print(f"FAIL  {name}: {len(rows)} / {len(other)} rows, columns {columns} / {other_columns}")
        ours, theirs = set(rows) - set(other), set(other) - set(rows)
        print("   only Spark:", sorted(ours)[:3], "\n   only SQL:  ", sorted(theirs)[:3], flush=True)
    print("failed:", failed)
    sys.exit(bool(failed))


SAME_TYPES = {("bigint", "BIGINT"), ("string", "VARCHAR"), ("boolean", "BOOLEAN"), ("double", "DOUBLE"), ("int", "INTEGER"),
              ("decimal(38,18)", "DECIMAL(38,18)")}

if __name__ == "__main__":
    main()
