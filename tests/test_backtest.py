import datetime as dt
import json

import pytest
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from periodlens.operators import panel, scoring
from periodlens.plans import backtest, warehouse
from periodlens.session import pin
from periodlens.sources import star_tables
from periodlens.sources.tables import append_version, read_version, version_folders, write_version

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def training(spark):
    facts = star_tables.load_facts(spark, FOLDER)
    return pin(panel.training_view(panel.build_panel(facts.employment, facts.incidents, facts.violations)), "t")


def test_run_writes_reports(spark, training, tmp_path):
    out = str(tmp_path / "out")
    run = backtest.run_backtest(training, [1999, 2000], ["rule_score", "logreg"], "run", output=out, min_validation_rows=1)
    splits = {(r.model_name, r.validation_year): r for r in run.splits.collect()}
    assert len(splits) == 4
    for (_, year), row in splits.items():
        assert row.n_train_rows == training.where(F.col("year") < year).count()
        assert row.n_validation_rows == training.where(F.col("year") == year).count()
        assert 0 <= row.roc_auc <= 1 and 0 < row.pr_auc <= 1
    assert run.summary.count() == 2 and run.claims.count() == 2
    assert spark.read.option("header", True).csv(f"{out}/split_metrics").count() == 4
    assert spark.read.option("header", True).csv(f"{out}/predictions").count() == run.scores.count()
    lines = [r.value for r in spark.read.text(f"{out}/business_claims").collect()]
    assert len(lines) == 2 and all(line.startswith("- ") for line in lines)
    version = "logreg_v1_mvp11_train_to_1999_validate_2000"
    metadata = json.loads(spark.read.text(f"{out}/models/{version}/metadata").first().value)
    assert metadata["validation_year"] == 2000 and len(metadata["coefficients"]) == 11
    model = LogisticRegressionModel.load(f"{out}/models/{version}/model")
    assert model.intercept == metadata["intercept"]
    again = backtest.score_from_models(training, out, {2000: version})
    assert again.count() > 0 and again.exceptAll(run.scores.where(F.col("model_version") == version)).count() == 0


def test_stored_models_that_do_not_fit_are_refused(training):
    width = len(panel.FEATURES)
    model = {
        "model_version": "v",
        "feature_columns": list(panel.FEATURES),
        "scaler_mean": [0.0] * width,
        "scaler_scale": [1.0] * width,
        "coefficients": [0.0] * width,
        "intercept": 0.0,
    }
    rows = scoring.score_with_models(training, {2000: model}).collect()
    assert len(rows) == training.where("year = 2000").count() and {r.risk_score for r in rows} == {0.5}
    for change, message in (
        ({"coefficients": [1.0]}, "coefficients of 2000 has 1 values"),
        ({"scaler_scale": [0.0] * width}, "divides by zero"),
        ({"feature_columns": ["other"] * width}, "missing from the panel"),
    ):
        with pytest.raises(ValueError, match=message):
            scoring.score_with_models(training, {2000: {**model, **change}})
    with pytest.raises(ValueError, match="other features"):
        scoring.score_with_models(training, {2000: model, 2001: {**model, "feature_columns": ["x"]}})


def test_gradient_tells_a_fitted_model_from_another(training):
    fitted = scoring.score_logistic(training, [2000])
    assert scoring.logistic_gradients(training, fitted).first().largest_gradient < 1e-4
    fitted.fitted[2000]["intercept"] += 0.1
    assert scoring.logistic_gradients(training, fitted).first().largest_gradient > 1e-3


def test_jobs_store_scores_results_and_checks(spark, tmp_path):
    facts = star_tables.load_facts(spark, FOLDER)
    home, early, late = str(tmp_path / "warehouse"), dt.datetime(2001, 3, 1), dt.datetime(2001, 3, 9)
    for name, rows in (("employment", facts.employment), ("incident", facts.incidents), ("violation", facts.violations)):
        append_version(rows, f"{home}/{name}")
    whole = warehouse.run_panel(spark, home, early)
    training = panel.training_view(whole)
    for now in (early, late):
        backtest.run_backtest(training, [2000], ["rule_score"], "run", min_validation_rows=1, store=home, now=now)
    scores = warehouse.current_table(spark, home, "risk_score")
    assert scores.count() == training.where("year = 2000").count()
    assert [r[0] for r in scores.select("prediction_ts").distinct().collect()] == [late]
    assert [r.backtest_result_key for r in warehouse.current_table(spark, home, "backtest_result").collect()] == [1]
    quality = warehouse.current_table(spark, home, "quality_result")
    keys = sorted(r.dq_key for r in quality.collect())
    assert keys == list(range(1, len(keys) + 1)) and quality.where("status <> 'PASS'").count() == 0
    report = {r.entity_name: r for r in warehouse.stored_freshness(spark, home, late).collect()}
    assert report["fact_risk_score"].latest_quality_check_ts == late
    assert report["fact_risk_score"].freshness_status == "Fresh" and report["dim_mine"].freshness_status == "Missing"

    bad = facts.employment.limit(1).withColumn("employee_hours", F.lit(-1e9).cast("decimal(14,2)"))
    append_version(bad, f"{home}/employment")
    with pytest.raises(ValueError, match="mine_quarter_base.*negative_denominator"):
        warehouse.run_panel(spark, home, late)
    failed = warehouse.current_table(spark, home, "quality_result").where("status = 'FAIL'").collect()
    assert [(r.test_name, r.severity, r.failure_count) for r in failed] == [("negative_denominator", "CRITICAL", 1)]
    assert read_version(spark, f"{home}/mine_quarter").count() == whole.count()


def test_refresh_rebuilds_only_mines_with_new_facts(spark, tmp_path):
    facts = star_tables.load_facts(spark, FOLDER)
    home, now = str(tmp_path / "warehouse"), dt.datetime(2001, 3, 1)
    by_mine = [r.mine_key for r in facts.employment.groupBy("mine_key").agg(F.count("*").alias("n")).orderBy("mine_key").collect()]
    late = by_mine[3]
    tables = dict(zip(warehouse.FACTS, (facts.employment, facts.incidents, facts.violations), strict=True))
    for name, rows in tables.items():
        append_version(rows.where((F.col("mine_key") != late) | F.lit(name != "incident")), f"{home}/{name}")
    assert len(warehouse.refresh_panel(spark, home, now, buckets=8)) == 8
    assert warehouse.refresh_panel(spark, home, now, buckets=8) == []

    before = version_folders(spark, f"{home}/mine_quarter")
    rest = tables["incident"].where(F.col("mine_key") == late)
    own = facts.employment.where(F.col("mine_key") == late).select("period_key").first()[0]
    event = tables["incident"].limit(1).withColumn("mine_key", F.lit(late).cast("long"))
    append_version(rest.unionByName(event.withColumn("incident_quarter", F.lit(own))), f"{home}/incident")
    written = warehouse.refresh_panel(spark, home, now, buckets=8)
    assert len(written) == 1
    after = version_folders(spark, f"{home}/mine_quarter")
    assert len(set(before) & set(after)) == 7

    stored = warehouse.current_table(spark, home, "mine_quarter")
    built = panel.build_panel(*[warehouse.current_table(spark, home, name) for name in warehouse.FACTS])
    assert stored.exceptAll(built).count() == 0 and built.exceptAll(stored).count() == 0
    assert stored.where((F.col("mine_key") == late) & (F.col("incident_count_current_qtr") > 0)).count() > 0

    bad = facts.employment.where(F.col("mine_key") == late).limit(1)
    append_version(bad.withColumn("employee_hours", F.lit(-1e9).cast("decimal(14,2)")), f"{home}/employment")
    with pytest.raises(ValueError, match="negative_denominator"):
        warehouse.refresh_panel(spark, home, now, buckets=8)
    assert version_folders(spark, f"{home}/mine_quarter") == after


def test_refresh_builds_whole_if_parts_are_unknown(spark, tmp_path):
    facts = star_tables.load_facts(spark, FOLDER)
    home, now = str(tmp_path / "warehouse"), dt.datetime(2001, 3, 1)
    for name, rows in zip(warehouse.FACTS, (facts.employment, facts.incidents, facts.violations), strict=True):
        append_version(rows, f"{home}/{name}")
    whole = warehouse.run_panel(spark, home, now)
    assert len(warehouse.refresh_panel(spark, home, now, buckets=4)) == 4
    stored = warehouse.current_table(spark, home, "mine_quarter")
    assert stored.exceptAll(whole).count() == 0 and stored.count() == whole.count()
    half = facts.employment.where(F.col("mine_key") % 2 == 0)
    write_version(half, f"{home}/employment")
    warehouse.refresh_panel(spark, home, now, buckets=4)
    stored = warehouse.current_table(spark, home, "mine_quarter")
    assert stored.count() == half.select("mine_key", "period_key").distinct().count()


def test_small_and_single_class_splits_are_skipped(training):
    small = backtest.run_backtest(training, [2000], ["rule_score"], min_train_rows=10**9)
    assert small.splits is None and small.scores.count() > 0 and len(small.skipped) == 1
    flat = backtest.run_backtest(training.withColumn(panel.LABEL, F.lit(0)), [2000], ["rule_score"])
    assert flat.scores is None and "one class" in flat.skipped[0]
    with pytest.raises(ValueError, match="unsupported"):
        backtest.run_backtest(training, [2000], ["other"])
    with pytest.raises(ValueError, match="empty"):
        backtest.run_backtest(training, [2050], ["rule_score"])
