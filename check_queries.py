"""Compare registered queries with their SQL in DuckDB: ``check_queries.py FOLDER [NAME ...]``."""

from __future__ import annotations

import importlib
import math
import sys
import tempfile
import time

import duckdb

from periodlens.session import get_session, release_pins

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _comparable(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def _rows(rows: list, names: list[str], wanted: list[str]) -> list[tuple]:
    places = [names.index(name) for name in wanted]
    return sorted(tuple(_comparable(row[i]) for i in places) for row in rows)


def main() -> int:
    folder, chosen = sys.argv[1], sys.argv[2:]
    entry = importlib.import_module("__spark_entry__")
    queries, sql = entry.queries(), entry.oracle_sql()
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="periodlens-"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = get_session("check", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    failed = 0
    for name in chosen or queries:
        start = time.perf_counter()
        found = queries[name](spark, folder)
        rows = found.collect()
        took = time.perf_counter() - start
        if name not in sql:
            print(f"rows  {name} {len(rows)} {took:.1f}s", flush=True)
            continue
        result = connection.execute(sql[name])
        names = [column[0] for column in result.description]
        order = sorted(names)
        same = sorted(found.columns) == order
        detail = "columns differ"
        if same:
            left, right = _rows(rows, found.columns, order), _rows(result.fetchall(), names, order)
            same = left == right
            different = [pair for pair in zip(left, right) if pair[0] != pair[1]][:1]
            detail = f"{len(left)} and {len(right)} rows, first difference {different}"
        failed += not same
        print(f"{'same ' if same else 'DIFF '} {name} {len(rows)} {took:.1f}s {'' if same else detail}", flush=True)
    release_pins(spark)
    return failed


if __name__ == "__main__":
    sys.exit(main())
