import dataclasses
import datetime as dt
import json
import random

import duckdb
import pytest

from pyspark.sql import functions as F

from periodlens.plans import staging, warehouse
from periodlens.sources import delimited, tables
from periodlens.sources.delimited import read_delimited, require_columns, resolve

NOW = dt.datetime(2021, 1, 1)


def write(path, *lines, encoding="latin-1"):
    path.write_bytes("\n".join(lines).encode(encoding) + b"\n")
    return str(path)


def test_delimited_edge_cases(spark, tmp_path):
    path = write(
        tmp_path / "f.txt",
        "Mine ID|S&S  (flag)|Note",
        '1|Y|"a|b"',
        '2|N|"say ""hi"""',
        "",
        "3|é",
        "4|Y|x|extra",
        '5|Y|"q|q"|extra',
        "6|Y|x|",
    )
    df = read_delimited(spark, path)
    rows = {r.mine_id: r for r in df.collect()}
    assert sorted(rows) == ["1", "2", "3", "4", "5", "6"]
    assert df.columns[:3] == ["mine_id", "s_s_flag", "note"]
    assert (rows["1"].note, rows["2"].note) == ("a|b", 'say "hi"')
    assert (rows["3"].s_s_flag, rows["3"].note, rows["3"]._too_many_fields) == ("é", None, False)
    assert sorted(k for k in rows if rows[k]._too_many_fields) == ["4", "5", "6"]
    in_order = df.orderBy("_file_path", "_block_start", "_line_order").collect()
    assert [r.mine_id for r in in_order] == ["1", "2", "3", "4", "5", "6"]


def test_repeated_header_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "f.txt", "a|A |b", '1|2|"x', 'y"', "3|4|z")
    rows = read_delimited(spark, path).orderBy("a").collect()
    assert [(r.a, r.b) for r in rows] == [("2", "x\ny"), ("4", "z")]


def test_resolution(spark):
    df = spark.createDataFrame([(None, "2020")], "cal_yr string, year string")
    assert df.select(resolve(df, ("cal_yr", "year"))).first()[0] is None
    assert df.select(resolve(df, ("other",))).first()[0] is None
    with pytest.raises(ValueError, match="quarter"):
        require_columns(df, ["year", "quarter"], {"year": ("cal_yr",)})


EMPLOYMENT_HEADER = "MINE_ID|CAL_YR|CAL_QTR|SUBUNIT_CD|AVG_EMPLOYEES|EMP_HOURS|PRODUCTION|UNIT"


def stage(spark, path, dataset, **options):
    return staging.stage_rows(read_delimited(spark, path), dataset, "run1", "f.txt", NOW, **options)


def test_employment_rules(spark, tmp_path):
    path = write(
        tmp_path / "f.txt",
        EMPLOYMENT_HEADER,
        "1|2020|1|A|2|1,000.50|10|t",
        "2|2020|5|A|2|10|10|t",
        "3|2020|1|A|-2|10|10|t",
        "4|20x|1|A|2|10|10|t",
        "5|2020|1|A|2|ten|10|t",
        "|2020|1|A|2|10|10|t",
        "7| |1|A|2|10|10|t",
        "8|2020|2",
    )
    staged = stage(spark, path, staging.EMPLOYMENT)
    rows = {r.mine_id: r for r in staged.accepted.collect()}
    assert sorted(rows) == ["1", "8"]
    assert (float(rows["1"].employee_hours), rows["1"].period_key) == (1000.5, "2020Q1")
    assert (rows["8"].subunit_code, rows["8"].employee_hours, rows["8"].period_key) == (None, None, "2020Q2")
    reasons = sorted(r.reject_reason for r in staged.rejected.collect())
    assert reasons == [
        "invalid employee_hours",
        "invalid quarter",
        "invalid year",
        "missing mine_id",
        "missing year",
        "negative avg_employees",
    ]
    stats = staged.statistics.first()
    assert (stats.rows_read, stats.rows_loaded, stats.rows_rejected, stats.status) == (8, 2, 6, "WARN")


def test_zero_and_blank_measures_share_an_id(spark, tmp_path):
    path = write(tmp_path / "f.txt", EMPLOYMENT_HEADER, "1|2020|1|A|0.00|1|1|t", "1|2020|1|A||1|1|t")
    with pytest.raises(ValueError, match="duplicate key"):
        stage(spark, path, staging.EMPLOYMENT)


def test_too_many_fields(spark, tmp_path):
    path = write(tmp_path / "f.txt", EMPLOYMENT_HEADER, "1|2020|1|A|1|1|1|t", "2|2020|1|A|1|1|1|t|more")
    with pytest.raises(ValueError, match="too many fields"):
        stage(spark, path, staging.EMPLOYMENT)
    staged = stage(spark, path, staging.EMPLOYMENT, on_too_many_fields="quarantine")
    assert (staged.accepted.count(), staged.rejected.count()) == (1, 1)


def test_first_violation_in_the_file_wins(spark, tmp_path):
    path = write(
        tmp_path / "f.txt",
        "MINE_ID|EVENT_NO|VIOLATION_NO|VIOLATION_ISSUE_DT|SECTION|LIKELIHOOD|S_AND_S",
        "1|e|v|03/07/2020|s|first|Y",
        *["1|e|v|2020-03-07|s|later|N"] * 50,
        "1|e|v|never|s|bad|N",
    )
    staged = stage(spark, path, staging.VIOLATIONS)
    row = staged.accepted.collect()
    assert len(row) == 1
    assert (row[0].likelihood_code, row[0].significant_substantial, row[0].violation_quarter) == ("first", True, "2020Q1")
    stats = staged.statistics.first()
    assert (stats.rows_read, stats.rows_loaded, stats.rows_rejected) == (52, 1, 1)


def test_assessed_date_is_optional_when_not_in_the_header_rules(spark, tmp_path):
    path = write(tmp_path / "f.txt", "MINE_ID|CASE_NO|ISSUE_DT|PROPOSED_PENALTY", "1|c|soon|5.00")
    staged = stage(spark, path, staging.ASSESSED, header_required=("mine_id",))
    assert staged.accepted.first().assessed_date is None
    assert stage(spark, path, staging.ASSESSED).accepted.count() == 0


def run_files(folder, hours):
    folder.mkdir()
    write(folder / "mines.txt", "MINE_ID|MINE_NAME|STATE|LATITUDE", "1|Alpha|WV|38.5", "2|Beta|KY|x")
    write(folder / "ep.txt", EMPLOYMENT_HEADER, f"1|2020|1|A|2|{hours}|10|t", "9|2020|1|A|2|5|10|t")
    write(folder / "inc.txt", "DOCUMENT_NO|MINE_ID|ACCIDENT_DT|LOST_DAYS", f"d1|1|2020-02-01|{hours}")
    write(folder / "vio.txt", "MINE_ID|EVENT_NO|VIOLATION_ISSUE_DT|S_AND_S", "1|e|2/1/2020|Y")
    write(folder / "asm.txt", "MINE_ID|CASE_NO|ISSUE_DT|PROPOSED_PENALTY|ASSESSED_AMOUNT", "1|c|2/1/2020|5|", "1|d|2/1/2020|5|3")
    names = dict(zip([d.name for d in staging.DATASETS], ["mines.txt", "ep.txt", "inc.txt", "vio.txt", "asm.txt"]))
    entries = [{"dataset_name": n, "txt_filename": f} for n, f in names.items()]
    (folder / "manifest.json").write_text(json.dumps({"run_id": "r", "datasets": entries}, indent=2))
    return entries


def test_two_runs_end_to_end(spark, tmp_path):
    home = str(tmp_path / "warehouse")
    run_files(tmp_path / "r1", 100)
    run_files(tmp_path / "r2", 200)
    first = staging.load_run(spark, str(tmp_path / "r1"), home, "r1", dt.datetime(2021, 1, 1))
    assert [s["dataset_name"] for s in first] == [d.name for d in staging.DATASETS]
    assert [s["rows_rejected"] for s in first] == [1, 0, 0, 0, 0]
    staging.load_run(spark, str(tmp_path / "r1"), home, "r1", dt.datetime(2021, 1, 1))
    staging.load_run(spark, str(tmp_path / "r2"), home, "r2", dt.datetime(2021, 1, 8))
    mines = spark.read.parquet(f"{home}/staging/stg_msha_mines")
    assert mines.count() == 2 and tables.latest_run(mines) == "r2"

    loaded = warehouse.run_warehouse_load(spark, home, NOW, "r1")
    assert loaded == {"mine": 1, "employment": 1, "incident": 1, "violation": 1, "assessed_violation": 2}
    again = warehouse.run_warehouse_load(spark, home, NOW, "r1")
    assert again == {"mine": 1, "employment": 0, "incident": 0, "violation": 0, "assessed_violation": 0}
    revised = warehouse.run_warehouse_load(spark, home, dt.datetime(2021, 1, 9))
    assert revised["employment"] == 1 and revised["incident"] == 0
    hours = {float(r.employee_hours) for r in tables.read_version(spark, f"{home}/employment").collect()}
    assert hours == {100.0, 200.0}
    assert tables.read_version(spark, f"{home}/employment", 1).count() == 1
    assert tables.read_version(spark, f"{home}/incident").first().lost_days == 100
    penalties = {float(r.penalty_amount) for r in tables.read_version(spark, f"{home}/assessed_violation").collect()}
    assert penalties == {5.0, 3.0}


def test_missing_required_dataset(spark, tmp_path):
    entries = run_files(tmp_path / "r1", 1)
    (tmp_path / "r1" / "manifest.json").write_text(json.dumps({"datasets": entries[:-1]}))
    with pytest.raises(ValueError, match="msha_assessed_violations"):
        staging.load_run(spark, str(tmp_path / "r1"), str(tmp_path / "w"), "r1", NOW)


def test_line_breaks_inside_quotes_invent_no_row(spark, tmp_path):
    path = write(tmp_path / "f.txt", "MINE_ID|MINE_NAME|STATE", '1|"Deep', "Hollow", "", 'Ridge"|AL', '2|"Up|Side"|KY')
    staged = stage(spark, path, staging.MINES)
    assert {(r.mine_id, r.mine_name) for r in staged.accepted.collect()} == {("1", "Deep\nHollow\n\nRidge"), ("2", "Up|Side")}


def test_open_quote_invents_no_row(spark, tmp_path):
    path = write(tmp_path / "f.txt", "MINE_ID|MINE_NAME|STATE", '2|"Up|Side"|KY', '1|"Deep', "3|Hollow|AL", '4|"Low"|AL')
    with pytest.raises(ValueError, match="unbalanced quotes.*not closed"):
        stage(spark, path, staging.MINES)
    staged = stage(spark, path, staging.MINES, on_too_many_fields="quarantine")
    assert [(r.mine_id, r.mine_name) for r in staged.accepted.collect()] == [("2", "Up|Side")]
    assert [r.reject_reason for r in staged.rejected.collect()] == ["unbalanced quotes"] * 3
    # A quote that closes too far away is as good as open.
    path = write(tmp_path / "g.txt", "a|b", '1|"x', *["y"] * 20, '"', "2|z")
    marked = delimited.read_delimited(spark, path, max_lines=10).groupBy(delimited.UNBALANCED_QUOTES).count().collect()
    assert {tuple(r) for r in marked} == {(True, 22), (False, 1)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_slices_cut_anywhere_equal_a_whole_read(spark, tmp_path, seed):
    random.seed(seed)
    (tmp_path / "d").mkdir()
    expected = []
    for part in range(3):
        lines = ["id|note|more"]
        for i in range(120):
            words = [random.choice(["a", "b|c", 'say ""hi""', "", "é", "x y"]) for _ in range(random.randint(1, 6))]
            note = "\n".join(words) if random.random() < (0.5 if part else 0) else words[0]
            lines.append(f'{part * 1000 + i}|"{note}"|{random.choice(["z", ""])}')
            if random.random() < 0.1:
                lines.append("")
            expected.append((str(part * 1000 + i), note.replace('""', '"') or None))
        write(tmp_path / "d" / f"{part}.txt", *lines)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    try:
        rows = delimited.read_delimited(spark, str(tmp_path / "d"))
        found = [(r.id, r.note) for r in rows.orderBy(*delimited.FILE_ORDER).collect()]
        assert not rows.where(delimited.UNBALANCED_QUOTES).count() and rows.select("_block_start").distinct().count() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert found == expected
    whole = duckdb.sql(
        f"SELECT id, note FROM read_csv('{tmp_path}/d/*.txt', delim='|', quote='\"', escape='\"', header=true, all_varchar=true,"
        " encoding='latin-1', null_padding=false, parallel=false) ORDER BY CAST(id AS INT)"
    ).fetchall()
    assert sorted((i, n or "") for i, n in found) == sorted((i, n or "") for i, n in whole)


def test_differing_headers(spark, tmp_path):
    (tmp_path / "d").mkdir()
    write(tmp_path / "d" / "a.txt", "MINE_ID|STATE", "1|AL")
    write(tmp_path / "d" / "b.txt", "STATE|MINE_ID", "AL|2")
    with pytest.raises(ValueError, match="differing headers"):
        delimited.read_delimited(spark, str(tmp_path / "d"))


def test_oversize_value_is_rejected(spark, tmp_path):
    path = write(tmp_path / "f.txt", EMPLOYMENT_HEADER, "1|2020|1|A|99999999999|5|10|t", "2|2020|1|A|2|5|10|t")
    staged = stage(spark, path, staging.EMPLOYMENT)
    assert [r.mine_id for r in staged.accepted.collect()] == ["2"]
    assert staged.rejected.first().reject_reason == "out of range avg_employees"


def test_failed_optional_dataset_is_reported(spark, tmp_path):
    run_files(tmp_path / "r1", 1)
    write(tmp_path / "r1" / "asm.txt", "OTHER", "1")
    optional = tuple(dataclasses.replace(d, required=d.name != staging.ASSESSED.name) for d in staging.DATASETS)
    found = staging.load_run(spark, str(tmp_path / "r1"), str(tmp_path / "w"), "r1", NOW, datasets=optional)
    assert found[-1]["status"] == "FAILED" and "missing required columns" in found[-1]["error"]
    assert found[0]["error"] is None and found[0]["duration_seconds"] > 0


def test_bad_row_leaves_the_old_version_current(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_version(spark.range(3), root)

    def refuse(df):
        raise ValueError(f"{df.count()} rows")

    with pytest.raises(ValueError, match="5 rows"):
        tables.write_version(spark.range(5), root, refuse)
    assert tables.read_version(spark, root).count() == 3
    home = str(tmp_path / "warehouse")
    run_files(tmp_path / "r1", 100)
    staging.load_run(spark, str(tmp_path / "r1"), home, "r1", NOW)
    warehouse.run_warehouse_load(spark, home, NOW, "r1")
    staged = spark.read.parquet(f"{home}/staging/stg_msha_incidents").withColumn("run_id", F.lit("bad"))
    bad = staged.selectExpr("*").withColumn("lost_days", F.lit(-4)).withColumn("source_record_id", F.lit("new"))
    for name in ("mines", "employment_production", "violations", "assessed_violations"):
        rows = spark.read.parquet(f"{home}/staging/stg_msha_{name}").where("run_id = 'r1'")
        tables.replace_run(rows.withColumn("run_id", F.lit("bad")), f"{home}/staging/stg_msha_{name}")
    tables.replace_run(bad, f"{home}/staging/stg_msha_incidents")
    with pytest.raises(ValueError, match="incident violates constraints"):
        warehouse.run_warehouse_load(spark, home, NOW, "bad")
    assert [r.lost_days for r in tables.read_version(spark, f"{home}/incident").collect()] == [100]


def test_typing_is_not_one_large_method(spark, monkeypatch):
    rows = spark.createDataFrame([("7", "a")], "mine_id string, mine_name string").select(
        "*",
        F.lit(False).alias("_too_many_fields"),
        F.lit(False).alias("_unbalanced_quotes"),
        F.lit("").alias("_file_path"),
        F.lit(0).alias("_block_start"),
        F.lit(0).alias("_line_order"),
    )
    seen, name, pin = [], "spark.sql.codegen.wholeStage", staging.pin
    monkeypatch.setattr(staging, "pin", lambda df, label: (seen.append(spark.conf.get(name)), pin(df, label))[1])
    before = spark.conf.get(name)
    staged = staging.stage_rows(rows, staging.MINES, "run", "mines.txt", dt.datetime(2020, 1, 1))
    assert seen == ["false"] and spark.conf.get(name) == before
    assert staged.accepted.count() == 1
