import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from periodlens.operators import merge
from periodlens.operators.merge import absent_rows, upsert
from periodlens.plans import warehouse
from periodlens.sources import tables

DAY_1, DAY_2 = dt.datetime(2020, 1, 1), dt.datetime(2020, 2, 1)
MINES = (
    "mine_id string, mine_name string, province_state string, commodity_group string, mine_type string, "
    "latitude decimal(10,6), longitude decimal(10,6)"
)


def mines(spark, *rows):
    return spark.createDataFrame([(i, n, s, None, None, None, None) for i, n, s in rows], MINES)


@pytest.fixture(scope="module")
def first_load(spark):
    empty = warehouse.empty_table(spark, "mine")
    return warehouse.load_mines(empty, mines(spark, ("a", "Alpha", "WV"), ("b", "Beta", "KY")), DAY_1).cache()


def test_dimension_upsert(spark, first_load):
    second = warehouse.load_mines(first_load, mines(spark, ("b", "Beta 2", None), ("c", "Gamma", "PA")), DAY_2)
    rows = {r.mine_id: r for r in second.collect()}
    old = {r.mine_id: r for r in first_load.collect()}
    assert {r.mine_key for r in old.values()} == {1, 2}
    assert (rows["a"].mine_key, rows["a"].updated_at) == (old["a"].mine_key, DAY_1)
    assert (rows["b"].mine_key, rows["b"].mine_name, rows["b"].province_state) == (old["b"].mine_key, "Beta 2", None)
    assert (rows["b"].created_at, rows["b"].updated_at) == (DAY_1, DAY_2)
    assert (rows["c"].mine_key, rows["c"].created_at, rows["c"].source_system) == (3, DAY_2, "MSHA")


def test_upsert_twice_is_once(spark, first_load):
    again = warehouse.load_mines(first_load, mines(spark, ("a", "Alpha", "WV"), ("b", "Beta", "KY")), DAY_1)
    assert sorted(again.collect()) == sorted(first_load.collect())


def test_insert_keeps_first_run_and_first_copy(spark):
    schema = "id string, value int"
    target = spark.createDataFrame([(1, "x", 10)], "k long, id string, value int")
    incoming = spark.createDataFrame([("x", 99), ("y", 5), ("y", 4)] + [("z", i) for i in range(500)], schema)
    merged = merge.insert_if_absent(target, incoming, ["id"], "k", ["value"])
    rows = sorted(tuple(r) for r in merged.collect())
    assert rows == [(1, "x", 10), (2, "y", 4), (3, "z", 0)]
    again = merge.insert_if_absent(merged, incoming, ["id"], "k", ["value"])
    assert sorted(tuple(r) for r in again.collect()) == rows


def test_revised_employment_adds_a_row(spark):
    columns = (
        "mine_key long, year int, quarter int, period_key string, avg_employees decimal(12,2), "
        "employee_hours decimal(14,2), production_volume decimal(16,2), production_unit string, "
        "source_record_id string, load_ts timestamp"
    )
    rows = spark.createDataFrame([(1, 2020, 1, "2020Q1", None, None, None, "t", "hash-1", DAY_1)], columns)
    revised = rows.withColumn("source_record_id", F.lit("hash-2"))
    loaded = warehouse.load_employment(warehouse.empty_table(spark, "employment"), rows)
    assert warehouse.load_employment(loaded, revised).count() == 2
    assert warehouse.load_employment(loaded, rows).count() == 1


def test_score_upsert(spark):
    schema = (
        "mine_key long, period_key string, model_version string, risk_score decimal(8,5), risk_band string, "
        "top_driver_1 string, top_driver_2 string, top_driver_3 string, label_next_period int"
    )
    row = (1, "2020Q1", "v", 0.5, "High", "a", None, None, 1)
    make = lambda score: spark.createDataFrame([row[:3] + (None,) + row[4:]], schema).withColumn(
        "risk_score", F.lit(score).cast("decimal(8,5)")
    )
    stored = warehouse.store_scores(warehouse.empty_table(spark, "risk_score"), make(0.5), DAY_1)
    again = warehouse.store_scores(stored, make(0.75), DAY_2).collect()
    assert len(again) == 1
    assert (float(again[0].risk_score), again[0].risk_score_key, again[0].prediction_ts) == (0.75, 1, DAY_2)


def test_require_unique(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    with pytest.raises(ValueError, match="duplicate key"):
        merge.require_unique(df, ["id"], "things")
    merge.require_unique(df.distinct(), ["id"], "things")


def test_duplicate_key_fails_an_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1)], "k long, id string, value int")
    incoming = spark.createDataFrame([("a", 2), ("b", 3), ("b", 4)], "id string, value int")
    with pytest.raises(Exception, match="duplicate key"):
        merge.upsert(target, incoming, ["id"], surrogate="k").collect()
    with pytest.raises(Exception, match="duplicate key"):
        merge.upsert(target.drop("k"), incoming, ["id"]).collect()


def test_upsert_exchanges_each_side_once(spark):
    target = spark.range(10).selectExpr("cast(id AS string) AS id", "1 AS value").repartition(3)
    incoming = spark.range(5, 15).selectExpr("cast(id AS string) AS id", "2 AS value").repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge.upsert(target, incoming, ["id"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning") == 2
    assert merged.groupBy("value").count().orderBy("value").collect() == [(1, 5), (2, 10)]


def _files(folders):
    return {f: (f.stat().st_mtime_ns, f.stat().st_size) for folder in folders for f in Path(folder).glob("*.parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root, keys = str(tmp_path / "scores"), ["k"]
    schema = "id bigint, k string, v int"

    def merge(old, new, highest):
        return upsert(old, new, keys, surrogate="id", highest=highest)

    first = spark.createDataFrame([(f"a{i}", i) for i in range(40)], "k string, v int")
    tables.upsert_version(first, root, keys, merge, schema, "id", buckets=8)
    before = tables.version_folders(spark, root)
    second = spark.createDataFrame([("a3", -3), ("new", 7)], "k string, v int")
    touched = tables.upsert_version(second, root, keys, merge, schema, "id", buckets=99)
    after = tables.version_folders(spark, root)
    assert 1 <= len(touched) <= 2 and len(set(before) & set(after)) >= len(before) - len(touched)
    kept = sorted(set(before) & set(after))
    assert all(_files(kept).values()) and kept
    rows = {r.k: (r.id, r.v) for r in tables.read_version(spark, root).collect()}
    old = {r.k: (r.id, r.v) for r in tables.read_version(spark, root, 1).collect()}
    assert len(rows) == 41 and rows["a3"] == (old["a3"][0], -3) and rows["new"] == (41, 7)
    assert {k: v for k, v in rows.items() if k not in ("a3", "new")} == {k: v for k, v in old.items() if k != "a3"}
    assert tables.upsert_version(second.limit(0), root, keys, merge, schema, "id") == []
    with pytest.raises(ValueError, match="not bucketed by"):
        tables.upsert_version(second, root, ["v"], merge, schema)
    with pytest.raises(ValueError, match="bucketed"):
        tables.append_version(tables.read_version(spark, root), root)


def test_refused_rows_leave_the_table_as_it_was(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1)], "k string, v int")

    def refuse(df):
        raise ValueError(f"refused {df.count()}")

    assert tables.append_version(rows, root) == 1
    with pytest.raises(ValueError, match="refused 1"):
        tables.append_version(rows, root, refuse)
    with pytest.raises(ValueError, match="refused"):
        tables.upsert_version(rows, str(tmp_path / "u"), ["k"], lambda old, new, _: old.unionByName(new), "k string, v int", check=refuse)
    assert len(tables.version_folders(spark, root)) == 1 and not list((tmp_path / "u").glob("version-*"))
    assert not [p for p in (tmp_path / "t").glob("part-*") if p.name not in tables.version_folders(spark, root)[0]]


def test_parts_are_listed_and_whole_versions_still_read(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    tables.write_version(rows, root)
    more = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    new = absent_rows(tables.read_version(spark, root), more, ["k"])
    assert tables.append_version(new, root) == 1
    assert sorted(tuple(r) for r in tables.read_version(spark, root).collect()) == [("a", 1), ("b", 2), ("c", 3)]
    again = absent_rows(tables.read_version(spark, root), more, ["k"])
    assert tables.append_version(again, root) == 0 and len(tables.version_folders(spark, root)) == 2
    assert tables.read_version(spark, root, 1).count() == 2
    empty = str(tmp_path / "e")
    assert tables.append_version(rows.limit(0), empty) == 0 and tables.read_version(spark, empty).columns == ["k", "v"]


def test_changes_between_runs(spark):
    staged = spark.createDataFrame(
        [("1", "a", "x"), ("1", "b", "x"), ("1", "c", "x"), ("2", "a", "x"), ("2", "b", "y"), ("2", "d", "x"), ("3", "e", "x")],
        "run_id string, source_record_id string, row_hash string",
    )
    found = {tuple(r) for r in tables.run_changes(staged, "1", "2").collect()}
    assert found == {("a", "same"), ("b", "changed"), ("c", "removed"), ("d", "added")}
