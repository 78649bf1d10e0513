import datetime as dt

import pytest
from pyspark.sql import functions as F

from periodlens.operators import checks
from periodlens.plans import reports, warehouse

AS_OF = dt.datetime(2021, 6, 30, 12)


@pytest.fixture(scope="module")
def scores(spark):
    rows = []
    for version in ("logreg_v1", "rule_score_v1"):
        for key in ("2020Q4", "2021Q1"):
            for mine, score, band, label in ((1, 0.9, "Critical", 1), (2, 0.3, "Medium", None), (3, 0.9, "Critical", 0)):
                rows.append((mine, key, version, score, band, f"driver {mine}", None, None, label, AS_OF))
    return spark.createDataFrame(
        rows,
        "mine_key long, period_key string, model_version string, risk_score double, risk_band string, "
        "top_driver_1 string, top_driver_2 string, top_driver_3 string, label_next_period int, "
        "prediction_ts timestamp",
    ).withColumn("risk_score", F.col("risk_score").cast("decimal(8,5)"))


@pytest.fixture(scope="module")
def mines(spark):
    return spark.createDataFrame(
        [(1, "m1", "One", "US", "WV", "Coal", "Surface"), (2, "m2", "Two", "US", None, "Stone", "Surface")],
        "mine_key long, mine_id string, mine_name string, country_code string, province_state string, "
        "commodity_group string, mine_type string",
    )


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame(
        [(1, "2021Q1", 10.0, 5.0, 2, 3, 1)],
        "mine_key long, period_key string, employee_hours double, production_volume double, "
        "incident_count_current_qtr long, violation_count_current_qtr long, had_incident_next_qtr int",
    )


def test_kpis(scores):
    rows = {(r.model_version, r.period_key): r for r in reports.kpi_summary(scores).collect()}
    assert len(rows) == 4
    row = rows["rule_score_v1", "2021Q1"]
    assert (row.model_name, row.summary_key) == ("rule_score", "rule_score_v1|2021Q1")
    assert (row.is_latest_period_for_model_flag, rows["rule_score_v1", "2020Q4"].is_latest_period_for_model_flag) == (1, 0)
    assert (row.total_mines_scored, row.avg_risk_score, row.median_risk_score) == (3, pytest.approx(0.7), pytest.approx(0.9))
    assert (row.critical_risk_mine_count, row.high_or_critical_risk_share) == (2, pytest.approx(2 / 3))
    assert (row.actual_positive_count, row.flagged_positive_count, row.flagged_positive_precision) == (1, 1, 0.5)
    latest = reports.latest_kpi(reports.kpi_summary(scores)).first()
    assert (latest.model_version, latest.period_key) == ("logreg_v1", "2021Q1")
    trend = reports.score_trend(reports.kpi_summary(scores), "logreg_v1").collect()
    assert [r.period_key for r in trend] == ["2020Q4", "2021Q1"]


def test_top_risk(scores, mines, features):
    top = reports.top_risk(scores, mines, features)
    rows = {(r.model_version, r.period_key, r.mine_key): r for r in top.collect()}
    ranks = [rows["logreg_v1", "2021Q1", mine].risk_rank for mine in (1, 3, 2)]
    assert ranks == [1, 2, 3]
    assert [rows["logreg_v1", "2021Q1", m].risk_percent_rank for m in (1, 3, 2)] == [0.0, 0.5, 1.0]
    assert rows["logreg_v1", "2021Q1", 1].employee_hours == 10.0
    assert (rows["logreg_v1", "2021Q1", 3].mine_id, rows["logreg_v1", "2020Q4", 1].employee_hours) == (None, None)
    filtered = reports.top_risk_listing(top, {"model_version": "logreg_v1", "period_key": "2021Q1", "risk_band": "Medium"})
    assert [(r.mine_key, r.risk_rank) for r in filtered.collect()] == [(2, 3)]
    narrowed = reports.top_risk(scores, mines, features, "logreg_v1", "2021Q1")
    assert {(r.mine_key, r.risk_rank) for r in narrowed.collect()} == {(1, 1), (3, 2), (2, 3)}
    assert {r.is_latest_period_for_model_flag for r in reports.top_risk(scores, mines, features, None, "2020Q4").collect()} == {0}
    with pytest.raises(ValueError, match="cannot filter"):
        reports.top_risk_listing(top, {"mine_name": "x"})
    assert [r[0] for r in reports.top_risk_choices(top)["states"].collect()] == ["WV"]
    assert reports.top_risk_listing(top, limit=2).count() == 2


def test_single_row_percent_rank(scores, mines, features):
    alone = reports.top_risk(scores.where("mine_key = 2"), mines, features).collect()
    assert {(r.risk_rank, r.risk_percent_rank) for r in alone} == {(1, 0.0)}


def test_value_counts(scores):
    counts = [tuple(r) for r in reports.value_counts(scores, "risk_band").collect()]
    assert counts == [("Critical", 8), ("Medium", 4)]
    assert reports.value_counts(scores, "top_driver_1", 1).count() == 1


@pytest.mark.parametrize(
    "age, status",
    [
        (dt.timedelta(days=7), "Fresh"),
        (dt.timedelta(days=7, seconds=1), "Warning"),
        (dt.timedelta(days=30), "Warning"),
        (dt.timedelta(days=30, seconds=1), "Stale"),
        (None, "Missing"),
    ],
)
def test_freshness(spark, age, status):
    names = {
        "dim_mine": "mine",
        "fact_msha_incident": "incident",
        "fact_msha_violation": "violation",
        "fact_msha_assessed_violation": "assessed_violation",
        "fact_msha_employment_production": "employment",
        "fact_risk_score": "risk_score",
        "fact_backtest_result": "backtest_result",
    }
    sources = {name: warehouse.empty_table(spark, table) for name, table in names.items()}
    if age is not None:
        stamped = spark.createDataFrame([(AS_OF - age,), (AS_OF - age - dt.timedelta(days=99),)], "load_ts timestamp")
        sources["fact_msha_incident"] = stamped
    quality = spark.createDataFrame(
        [
            (1, "fact_msha_incident", "FAIL", "HIGH", AS_OF),
            (2, "fact_msha_incident", "PASS", "LOW", AS_OF),
            (3, "fact_msha_incident", "WARN", "LOW", AS_OF - dt.timedelta(days=1)),
        ],
        "dq_key long, entity_name string, status string, severity string, checked_at timestamp",
    )
    rows = {r.entity_name: r for r in reports.source_freshness(sources, quality, AS_OF).collect()}
    assert len(rows) == 7
    row = rows["fact_msha_incident"]
    assert (row.freshness_status, row.latest_quality_status) == (status, "PASS")
    assert row.freshness_age_hours == (None if age is None else pytest.approx(age.total_seconds() / 3600))
    assert rows["dim_mine"].latest_quality_status is None


def test_constraints(spark, mines):
    fact = spark.createDataFrame(
        [(1, 2020, 1, "2020Q1", "a"), (9, 1999, 5, "1999Q4", "b"), (9, 2020, 1, "2020Q1", "b"), (1, 2020, 1, "2020Q1", "a")],
        "mine_key long, year int, quarter int, period_key string, source_record_id string",
    ).withColumns({n: F.lit(-1.0) for n in ("avg_employees", "employee_hours", "production_volume")})
    counts = {r.test_name: r.failure_count for r in checks.constraint_report(fact, "employment", mines).collect()}
    assert counts["invalid_year"] == counts["invalid_quarter"] == counts["period_mismatch"] == 1
    assert counts["negative_employee_hours"] == 4
    assert counts["duplicate_key"] == 1
    assert counts["unknown_mine_key"] == 2
    results = checks.quality_results(checks.constraint_report(fact, "employment"), "run", "fact", AS_OF)
    assert {r.status for r in results.where("failure_count > 0").collect()} == {"FAIL"}
    assert checks.constraint_report(results, "quality_result").agg(F.sum("failure_count")).first()[0] == 0
