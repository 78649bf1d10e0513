import importlib
import re
from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
TABLES = ("part", "lineitem", "orders")

entry = importlib.import_module("__spark_entry__")


def test_sql_keys_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    registered, sql = entry.registered.queries(), entry.oracle.oracle_sql()
    assert set(registered) - set(sql) == {"logistic_scores", "rolling_backtest"}


def test_no_machine_local_tricks_in_the_library():
    source = "\n".join(p.read_text() for p in Path(entry.__file__).parent.glob("periodlens/**/*.py"))
    assert not re.search(r"localCheckpoint|crossJoin|toPandas|@udf|pandas_udf", source)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name",
    [
        "features_full",
        "rule_scores",
        "top_risk",
        "dim_upsert",
        "staging_statistics",
        "logistic_given",
        "logistic_optimality",
        "quality_store",
    ],
)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = connection.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    found = entry.queries()[name](spark, FOLDER)
    assert sorted(names) == sorted(found.columns)
    key = lambda row: tuple(str(v) for v in row)
    wanted = sorted((tuple(r) for r in result.fetchall()), key=key)
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=key) == wanted
