"""Every registered query, each over the whole given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.oracle import GIVEN_COEFFICIENTS, GIVEN_INTERCEPT
from periodlens.functions import text
from periodlens.functions.numbers import age_hours, guarded_ratio
from periodlens.functions.period import next_period_key, period_of_date, period_quarter, period_year
from periodlens.operators import checks, metrics, ordering, panel, scoring
from periodlens.operators.merge import absent_rows, upsert
from periodlens.plans import backtest, reports, staging, warehouse
from periodlens.session import pin, scratch_path
from periodlens.sources import star_tables
from periodlens.sources.delimited import TOO_MANY_FIELDS, UNBALANCED_QUOTES, read_delimited
from periodlens.sources.tables import append_version, read_metadata, read_version, replace_run, upsert_version
from periodlens.sources.tables import run_changes as compare_runs
from periodlens.sources.tables import write_metadata

YEARS = (1999, 2000, 2001)
AS_OF = dt.datetime(2002, 1, 1)
EARLY_RUN = dt.datetime(2001, 3, 1)
LATE_RUN = dt.datetime(2001, 6, 1)
# Largest gradient component, by row, of a model that counts as fitted.
GRADIENT_LIMIT = 1e-4
# The first run holds what had shipped before this day, the second run all.
FIRST_RUN_END = "1995-01-20"

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as double and ints as bigint, to compare across engines."""
    casts = {T.DecimalType: "double", T.IntegerType: "bigint", T.ShortType: "bigint", T.ByteType: "bigint"}
    return df.select(
        *[
            F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name) if type(f.dataType) in casts else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name).cast("double"), 8) for name in names})


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    facts = star_tables.load_facts(spark, folder)
    return panel.build_panel(facts.employment, facts.incidents, facts.violations)


def _rule_scores(spark: SparkSession, folder: str, training: DataFrame | None = None) -> DataFrame:
    """Rule scores of all validation years."""
    if training is None:
        training = pin(panel.training_view(_panel(spark, folder)), "training")
    return scoring.score_rule(training, YEARS).rows


def _stored_scores(spark: SparkSession, folder: str, training: DataFrame | None = None) -> DataFrame:
    return pin(scoring.stored_scores(_rule_scores(spark, folder, training), AS_OF), "stored-scores")


# --- panel -----------------------------------------------------------------


def spine_agg(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(panel.activity_spine(star_tables.load_facts(spark, folder).employment))


def event_counts(spark: SparkSession, folder: str) -> DataFrame:
    facts = star_tables.load_facts(spark, folder)
    counted = panel.incident_counts(facts.incidents).join(
        panel.violation_counts(facts.violations), ["mine_key", "period_key"], "full_outer"
    )
    return _plain(counted.na.fill(0))


def panel_base(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(panel.base_view(_panel(spark, folder)))


def next_period_label(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(panel.label_view(_panel(spark, folder)))


def _panel_columns(*names: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _plain(_panel(spark, folder).select("mine_key", "period_key", *names))

    return query


rates = _panel_columns(
    "incident_rate_per_200k_hours_current_qtr",
    "violation_rate_per_10k_hours_current_qtr",
    "production_per_employee_hour_current_qtr",
)
qoq_deltas = _panel_columns(
    "incident_rate_per_200k_hours_prior_qtr",
    "violation_rate_per_10k_hours_prior_qtr",
    "production_per_employee_hour_prior_qtr",
    "incident_rate_qoq_delta",
    "violation_rate_qoq_delta",
    "production_efficiency_qoq_delta",
)
rolling4 = _panel_columns("feat_rolling_4q_incident_count", "feat_rolling_4q_violation_count")
ss_share_lag = _panel_columns("feat_ss_share", "feat_prior_lost_day_incident_count")
deterioration_flag = _panel_columns("deterioration_flag_current_qtr")
streak = _panel_columns("deterioration_flag_current_qtr", "feat_deterioration_streak_count")


def features_full(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(panel.feature_view(_panel(spark, folder)))


def training_split(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and positives on each side of every validation year."""
    training = panel.training_view(_panel(spark, folder)).select("year", panel.LABEL)
    sides = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(year).alias("validation_year"),
                    F.when(F.col("year") < year, "train").when(F.col("year") == year, "valid").alias("side"),
                )
                for year in YEARS
            ]
        )
    )
    marked = training.select(panel.LABEL, sides.alias("s")).select(panel.LABEL, "s.*").where("side IS NOT NULL")
    return _plain(
        marked.groupBy("validation_year", "side").agg(
            F.count("*").alias("row_count"), F.sum(F.col(panel.LABEL).cast("long")).alias("positive_count")
        )
    )


# --- warehouse -------------------------------------------------------------


def dim_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """All parts over a first load of the parts shipped early on."""
    parts = star_tables.load_staged(spark, folder)["mine"]
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").where(F.col("l_shipdate") < FIRST_RUN_END)
    early = parts.join(lines.select(F.col("l_partkey").cast("string").alias("mine_id")), "mine_id", "left_semi")
    old_names = early.withColumn("mine_name", F.upper("mine_name"))
    first = warehouse.load_mines(warehouse.empty_table(spark, "mine"), old_names, EARLY_RUN)
    revised = parts.withColumn("province_state", F.when(F.col("mine_type") != "7", F.col("province_state")))
    merged = warehouse.load_mines(pin(first, "mine"), revised, LATE_RUN)
    return _plain(
        merged.select(
            "mine_key", "mine_id", "source_system", "mine_name", "country_code", "province_state",
            "commodity_group", "mine_type", "active_flag", "created_at", "updated_at",
        )
    )


def fact_insert_absent(spark: SparkSession, folder: str) -> DataFrame:
    """Full resend over a first load: known documents stay, copies collapse."""
    staged = star_tables.load_staged(spark, folder)["incident"]
    lines = _incident_documents(staged)
    empty = warehouse.empty_table(spark, "incident")
    early = lines.where(F.col("incident_date") < F.lit("1998-01-01").cast("date"))
    first = pin(warehouse.load_incidents(empty, early), "incident")
    resent = lines.withColumn("lost_days", F.col("lost_days") + 100)
    return _plain(warehouse.load_incidents(first, resent).drop("load_ts", "days_restricted"))


def _incident_documents(staged: DataFrame) -> DataFrame:
    """Incidents numbered by mine and day, so some numbers repeat."""
    return staged.select(
        F.col("mine_id").cast("long").alias("mine_key"),
        "incident_date",
        "incident_quarter",
        F.col("incident_type_raw").alias("incident_type"),
        F.col("severity_class_raw").alias("severity_class"),
        "lost_days",
        "days_restricted",
        "hours_worked_basis",
        F.concat_ws("-", "mine_id", "incident_date").alias("source_record_id"),
        F.lit(EARLY_RUN).cast("timestamp").alias("load_ts"),
    )


def _fact_load(name: str, to_rows: Callable, load: Callable) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        staged = star_tables.load_staged(spark, folder)
        mines = star_tables.load_mines(spark, folder)
        loaded = load(warehouse.empty_table(spark, name), to_rows(staged[name], mines, EARLY_RUN))
        return _plain(loaded)

    return query


def constraint_report(spark: SparkSession, folder: str) -> DataFrame:
    facts = star_tables.load_facts(spark, folder)
    tables = {"employment": facts.employment, "incident": facts.incidents, "violation": facts.violations}
    reports_ = [
        checks.constraint_report(df, name, facts.mines).withColumn("entity_name", F.lit(name))
        for name, df in tables.items()
    ]
    return _plain(reduce(DataFrame.unionByName, reports_).drop("is_statistic"))


# --- checks ----------------------------------------------------------------


def dq_base(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(checks.base_checks(panel.base_view(pin(_panel(spark, folder), "panel"))))


def dq_labels(spark: SparkSession, folder: str) -> DataFrame:
    whole = pin(_panel(spark, folder), "panel")
    return _plain(checks.label_checks(panel.label_view(whole), panel.base_view(whole)))


def dq_features(spark: SparkSession, folder: str) -> DataFrame:
    whole = pin(_panel(spark, folder), "panel")
    return _plain(
        checks.feature_checks(panel.feature_view(whole), panel.label_view(whole), panel.training_view(whole))
    )


def score_checks(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(checks.score_checks(_rule_scores(spark, folder)))


# --- scores and metrics ------------------------------------------------------


def rule_bounds(spark: SparkSession, folder: str) -> DataFrame:
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    return _rounded(_plain(scoring.rule_bounds(training, YEARS)), "p05", "p95")


def rule_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = _plain(_rule_scores(spark, folder)).drop(*scoring.DRIVER_COLUMNS)
    return _rounded(scores, "risk_score")


def score_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A later run scores its last year again and adds one."""
    scores = _stored_scores(spark, folder)
    year = period_year(F.col("period_key"))
    empty = warehouse.empty_table(spark, "risk_score")
    first = pin(warehouse.store_scores(empty, scores.where(year <= YEARS[1]), EARLY_RUN), "risk-score")
    again = scores.where(year >= YEARS[1]).withColumn("top_driver_3", F.lit(None).cast("string"))
    return _plain(warehouse.store_scores(first, again, LATE_RUN))


def rule_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return _rule_scores(spark, folder).select("mine_key", "period_key", "model_version", *scoring.DRIVER_COLUMNS)


def scaler_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and deviation that each split's logistic model scales its features with."""
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    fitted = scoring.population_scaler(training, YEARS, panel.FEATURES)
    rows = [(year, name, float(mean), float(scale)) for year, of in fitted.items() for name, (mean, scale) in of.items()]
    return _rounded(_plain(spark.createDataFrame(rows, "year int, feature string, mean double, scale double")), "mean", "scale")


def stored_score_count(spark: SparkSession, folder: str) -> DataFrame:
    """Stored scores of each split that meet a training row of its year."""
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    scores = pin(_stored_scores(spark, folder, training), "scores")
    counts = [
        checks.stored_score_count(scores, training, scoring.model_version("rule_score", year), year).select(
            F.lit(year).alias("year"), "row_count"
        )
        for year in YEARS
    ]
    return _plain(reduce(DataFrame.unionByName, counts))


def backtest_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Input of the metrics, measured as if the last split were not expected."""
    return _plain(checks.backtest_checks(_rule_scores(spark, folder), YEARS[:2]))


def logistic_scores(spark: SparkSession, folder: str) -> DataFrame:
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    return scoring.score_logistic(training, YEARS).rows


def logistic_given(spark: SparkSession, folder: str) -> DataFrame:
    """Scores, bands and drivers of stored models: written coefficients, each split's own scaler."""
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    scalers = scoring.population_scaler(scoring.impute_zero(training, panel.FEATURES), YEARS, panel.FEATURES)
    models = {}
    for year, scaler in scalers.items():
        path = scratch_path(spark, f"model-{year}")
        metadata = {
            "model_version": scoring.model_version("logreg", year, "given"),
            "feature_columns": list(panel.FEATURES),
            "scaler_mean": [scaler[f][0] for f in panel.FEATURES],
            "scaler_scale": [scaler[f][1] for f in panel.FEATURES],
            "coefficients": [GIVEN_COEFFICIENTS[f] for f in panel.FEATURES],
            "intercept": GIVEN_INTERCEPT,
        }
        write_metadata(spark, metadata, path)
        models[year] = read_metadata(spark, path)
    return _rounded(_plain(scoring.score_with_models(training, models)), "risk_score")


def logistic_optimality(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the fitted model of each split is where the gradient of the loss vanishes."""
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    found = scoring.logistic_gradients(training, scoring.score_logistic(training, YEARS))
    return _plain(
        found.select(
            "year", "n_train_rows", "n_train_positives", (F.col("largest_gradient") < GRADIENT_LIMIT).alias("optimal")
        )
    )


def score_ranks(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_scores(spark, folder).withColumn("year", period_year(F.col("period_key")))
    ranked = metrics.rank_scores(stored)
    return _plain(ranked.select("model_version", "mine_key", "period_key", "risk_score", "score_rank", "split_rows"))


def _scored_for_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Scores rounded as stored, so that both engines see the same ties."""
    return _stored_scores(spark, folder).withColumn("year", period_year(F.col("period_key")))


def topk_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = _plain(metrics.top_fraction_metrics(_scored_for_metrics(spark, folder)))
    return _rounded(
        found, "base_rate", "precision_at_top_decile", "recall_at_top_decile", "lift_vs_base_rate"
    )


def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_plain(metrics.ranking_quality(_scored_for_metrics(spark, folder))).drop("pr_auc"), "roc_auc")


def avg_precision(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_plain(metrics.ranking_quality(_scored_for_metrics(spark, folder))).drop("roc_auc"), "pr_auc")


def _backtest_results(spark: SparkSession, folder: str) -> DataFrame:
    """Split metrics as the backtest table stores them."""
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    run = backtest.run_backtest(training, YEARS, ["rule_score"], run_id="run")
    empty = warehouse.empty_table(spark, "backtest_result")
    return pin(warehouse.store_backtest(empty, run.splits, AS_OF), "backtest-result")


def backtest_summary(spark: SparkSession, folder: str) -> DataFrame:
    view = _plain(reports.backtest_summary(_backtest_results(spark, folder)))
    summed = [name for name, kind in view.dtypes if kind == "double" and name.startswith(("macro_", "pooled_"))]
    return _rounded(view, *summed)


def backtest_store(spark: SparkSession, folder: str) -> DataFrame:
    """The stored results after two runs; the second measures the first one's last year again."""
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    home = scratch_path(spark, "warehouse")
    for run_id, years, now in (("early", YEARS[:2], EARLY_RUN), ("late", YEARS[1:], LATE_RUN)):
        backtest.run_backtest(training, years, ["rule_score"], run_id, store=home, now=now)
    return _plain(warehouse.current_table(spark, home, "backtest_result"))


def quality_store(spark: SparkSession, folder: str) -> DataFrame:
    """Quality results after a panel job and a backtest over the stored tables."""
    facts = star_tables.load_facts(spark, folder)
    home = scratch_path(spark, "warehouse")
    for name, rows in (
        ("employment", facts.employment),
        ("incident", facts.incidents),
        ("violation", facts.violations),
    ):
        append_version(rows, f"{home}/{name}")
    whole = warehouse.run_panel(spark, home, EARLY_RUN)
    backtest.run_backtest(panel.training_view(whole), YEARS, ["rule_score"], "late", store=home, now=LATE_RUN)
    return _plain(warehouse.current_table(spark, home, "quality_result"))


def panel_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Features of a stored panel that was refreshed when the facts of some mines came in late."""
    facts = star_tables.load_facts(spark, folder)
    home, late = scratch_path(spark, "warehouse"), F.pmod(F.xxhash64("mine_key"), F.lit(10)) == 0
    # Late mines report once early, so the second load has to change rows that are there.
    activity, quarter = facts.employment, F.col("period_key")
    loads = (
        (activity.where(~late | (quarter < "1997")), facts.incidents.where(~late), facts.violations),
        (activity.where(late & (quarter >= "1997")), facts.incidents.where(late), facts.violations.limit(0)),
    )
    for now, load in zip((EARLY_RUN, LATE_RUN), loads, strict=True):
        for name, rows in zip(warehouse.FACTS, load, strict=True):
            append_version(rows, f"{home}/{name}")
        warehouse.refresh_panel(spark, home, now)
    return _plain(panel.feature_view(warehouse.current_table(spark, home, "mine_quarter")))


def rolling_backtest(spark: SparkSession, folder: str) -> DataFrame:
    """Both models over all years, splits measured together."""
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    return backtest.run_backtest(training, YEARS, ["rule_score", "logreg"]).splits


# --- reports ---------------------------------------------------------------


def kpi_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(
        _plain(reports.kpi_summary(_stored_scores(spark, folder))),
        "avg_risk_score", "median_risk_score", "high_or_critical_risk_share", "flagged_positive_precision",
    )


def kpi_latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = reports.latest_kpi(reports.kpi_summary(_stored_scores(spark, folder)))
    return _rounded(
        _plain(latest.select("model_version", "period_key", "total_mines_scored", "avg_risk_score")), "avg_risk_score"
    )


def kpi_listing(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(
        _plain(reports.kpi_listing(reports.kpi_summary(_stored_scores(spark, folder)))),
        "avg_risk_score", "median_risk_score", "high_or_critical_risk_share", "flagged_positive_precision",
    )


def score_trend(spark: SparkSession, folder: str) -> DataFrame:
    kpis = reports.kpi_summary(_stored_scores(spark, folder))
    return _rounded(_plain(reports.score_trend(kpis, scoring.model_version("rule_score", YEARS[1]))), "avg_risk_score")


def _top_risk(spark: SparkSession, folder: str) -> DataFrame:
    mines = star_tables.load_mines(spark, folder)
    features = pin(panel.feature_view(_panel(spark, folder)), "features")
    return reports.top_risk(_stored_scores(spark, folder, panel.training_view(features)), mines, features)


def top_risk(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_plain(_top_risk(spark, folder)), "risk_percent_rank")


def top_risk_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Top-k report with filters on score and mine attributes."""
    filters = {"model_version": scoring.model_version("rule_score", 2000), "commodity_group": "ECONOMY"}
    return _plain(reports.top_risk_listing(_top_risk(spark, folder), filters, 50))


def _detail(spark: SparkSession, folder: str) -> DataFrame:
    mines = star_tables.load_mines(spark, folder)
    whole = pin(_panel(spark, folder), "panel")
    return reports.mine_detail(_stored_scores(spark, folder, panel.training_view(whole)), mines, whole)


def entity_detail(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_detail(spark, folder))


def entity_detail_row(spark: SparkSession, folder: str) -> DataFrame:
    version = scoring.model_version("rule_score", 2000)
    return _plain(reports.detail_row(_detail(spark, folder), version, "2000Q2", "7"))


def entity_history(spark: SparkSession, folder: str) -> DataFrame:
    version = scoring.model_version("rule_score", 2000)
    return _plain(reports.mine_history(_detail(spark, folder), version, "7"))


def distinct_filters(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.top_risk_choices(_top_risk(spark, folder))
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(label).alias("choice"), F.col(df.columns[0]).alias("choice_value"))
            for label, df in found.items()
        ],
    )


def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored_scores(spark, folder)
    bands = reports.value_counts(stored, "risk_band").withColumnRenamed("risk_band", "counted_value")
    drivers = reports.value_counts(stored, "top_driver_1", 10).withColumnRenamed("top_driver_1", "counted_value")
    return bands.withColumn("counted", F.lit("risk_band")).unionByName(
        drivers.withColumn("counted", F.lit("top_driver_1"))
    )


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    facts = star_tables.load_facts(spark, folder)
    training = pin(panel.training_view(_panel(spark, folder)), "training")
    scores = scoring.stored_scores(_rule_scores(spark, folder, training), dt.datetime(2001, 12, 25))
    empty = {name: warehouse.empty_table(spark, name) for name in ("assessed_violation", "backtest_result")}
    sources = {
        "dim_mine": facts.mines,
        "fact_msha_incident": facts.incidents,
        "fact_msha_violation": facts.violations,
        "fact_msha_assessed_violation": empty["assessed_violation"],
        "fact_msha_employment_production": facts.employment,
        "fact_risk_score": scores,
        "fact_backtest_result": empty["backtest_result"],
    }
    results = [
        checks.quality_results(checks.constraint_report(df, table), "run", name, dt.datetime(2001, 12, 24))
        for name, table, df in (
            ("fact_msha_employment_production", "employment", facts.employment),
            ("fact_msha_incident", "incident", facts.incidents),
        )
    ]
    quality = ordering.rank_rows(
        reduce(DataFrame.unionByName, results), [], ["entity_name", F.desc("test_name")], "dq_key"
    )
    return _rounded(_plain(reports.source_freshness(sources, quality, AS_OF)), "freshness_age_hours")


# --- cleaning and staging --------------------------------------------------


def clean_scalars(spark: SparkSession, folder: str) -> DataFrame:
    """Untidy texts made from orders, cleaned and typed."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    day = F.col("o_orderdate").cast("date")
    first = F.substring("o_orderpriority", 1, 1)
    untidy = orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        F.concat(F.lit(" \t"), "o_orderpriority", F.lit(" ")).alias("text"),
        F.when(first == "1", " Yes ").when(first == "2", "F").when(first == "3", "0").otherwise("TRUE").alias("flag"),
        F.when(first == "4", F.concat("o_custkey", F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), "o_custkey"))
        .alias("whole"),
        F.format_number("o_totalprice", 2).alias("money"),
        F.when(first == "1", F.date_format(day, "M/d/yyyy"))
        .when(first == "2", F.date_format(day, "yyyyMMdd"))
        .when(first == "3", F.date_format(day, "dd-MMM-yyyy"))
        .when(first == "4", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 00:00")))
        .otherwise(F.date_format(day, "yyyy/M/d"))
        .alias("day"),
    )
    parsed = text.parse_date(F.col("day"))
    price = text.parse_decimal(F.col("money"))
    key = period_of_date(parsed)
    return _plain(
        untidy.select(
            "o_orderkey",
            text.clean_text(F.col("text")).alias("clean_text"),
            text.parse_bool(F.col("flag")).alias("flag"),
            text.parse_int(F.col("whole")).alias("whole_number"),
            text.is_unparsable(F.col("whole"), text.parse_int(F.col("whole"))).alias("whole_rejected"),
            price.cast("decimal(16,2)").alias("amount"),
            parsed.alias("parsed_date"),
            key.alias("period_key"),
            period_year(key).alias("year"),
            period_quarter(key).alias("quarter"),
            next_period_key(F.year(parsed), F.quarter(parsed)).alias("next_period_key"),
            text.record_id([F.col("o_orderkey"), key, text.decimal_id_text(F.col("money"))]).alias("record_id"),
            text.composite_key(F.col("o_orderkey"), key).alias("row_key"),
            guarded_ratio(price, text.parse_int(F.col("whole"))).alias("price_per_customer_key"),
            text.fixed_digits(F.col("o_custkey") / 8, 1).alias("one_digit"),
            F.round(age_hours(F.lit(AS_OF).cast("timestamp"), F.col("o_orderdate").cast("timestamp")), 8).alias(
                "age_hours"
            ),
        )
    )


def _staged(spark: SparkSession, folder: str, dataset: staging.Dataset) -> staging.Staged:
    target = f"{scratch_path(spark, 'raw')}/{dataset.name}"
    star_tables.write_raw_file(spark, folder, dataset.name, target)
    rows = read_delimited(spark, target)
    return staging.stage_rows(rows, dataset, "run", f"{dataset.name}.txt", AS_OF)


def _staged_query(dataset: staging.Dataset) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        accepted = _staged(spark, folder, dataset).accepted
        return _plain(accepted.drop("row_hash", "ingested_at"))

    return query


def staging_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [_staged(spark, folder, dataset).statistics for dataset in staging.DATASETS]
    )


def staging_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName,
        [
            _staged(spark, folder, dataset)
            .rejected.groupBy("reject_reason")
            .agg(F.count("*").alias("row_count"))
            .withColumn("dataset_name", F.lit(dataset.name))
            for dataset in staging.DATASETS
        ],
    )


def staging_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Mines made from parts, some with line breaks inside quotes, too many fields, or a latitude that is no number or too
    large; also the line breaks that accepted names kept."""
    key = F.col("p_partkey").cast("string")
    fault = F.col("p_partkey") % 10
    line = F.concat_ws("|", key, F.lit("Deep"), F.lit("AL"), F.lit("1.5"))
    lines = (
        F.when(
            fault == 1,
            F.concat(
                F.array(F.concat(key, F.lit('|"Deep'))),
                F.array_repeat(F.lit('Run|""Creek""'), (F.col("p_partkey") / 10).cast("int") % 4),
                F.array(F.lit('Hollow"|AL|1.5')),
            ),
        )
        .when(fault == 2, F.array(F.concat(line, F.lit("|more"))))
        .when(fault == 3, F.array(F.concat_ws("|", key, F.lit("Deep"), F.lit("AL"), F.lit("99999"))))
        .when(fault == 4, F.array(F.concat_ws("|", key, F.lit("Deep"), F.lit("AL"), F.lit("north"))))
        .otherwise(F.array(line))
    )
    target = f"{scratch_path(spark, 'raw')}/faults"
    raw = spark.read.parquet(f"{folder}/part.parquet").select(F.explode(lines).alias("MINE_ID|MINE_NAME|STATE|LATITUDE"))
    raw.write.option("header", True).option("quote", "").option("sep", "\x01").csv(target)
    staged = staging.stage_rows(
        read_delimited(spark, target), staging.MINES, "run", "faults.txt", AS_OF, on_too_many_fields="quarantine"
    )
    breaks = F.regexp_count("mine_name", F.lit("\n")).cast("long")
    reasons = staged.rejected.select("reject_reason", F.lit(0).cast("long").alias("breaks")).unionByName(
        staged.accepted.select(F.lit("accepted").alias("reject_reason"), breaks.alias("breaks"))
    )
    counted = reasons.groupBy("reject_reason").agg(F.count("*").alias("row_count"), F.sum("breaks").alias("line_breaks"))
    return _plain(counted)


def _made_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two staged runs of mines: the second lacks every seventh part, renames every fifth and has every eleventh anew."""
    part = spark.read.parquet(f"{folder}/part.parquet")
    key, second = F.col("p_partkey"), F.col("run_id") == "2"
    there = F.when(second, key % 7 != 0).otherwise(key % 11 != 0)
    name = F.when(second & (key % 5 == 0), F.upper("p_name")).otherwise(F.col("p_name"))
    rows = part.withColumn("run_id", F.explode(F.array(F.lit("1"), F.lit("2")))).where(there)
    raw = rows.select("run_id", key.cast("string").alias("mine_id"), name.alias("mine_name"), F.col("p_brand").alias("state"))
    staged = [
        staging.type_rows(
            raw.where(F.col("run_id") == run).select(
                "mine_id", "mine_name", "state", *_no_file_position()
            ),
            staging.MINES, run, "mines.txt", AS_OF,
        )
        for run in ("1", "2")
    ]
    return staged[0].unionByName(staged[1])


def _no_file_position() -> list[Column]:
    return [
        F.lit(False).alias(TOO_MANY_FIELDS),
        F.lit(False).alias(UNBALANCED_QUOTES),
        F.lit("").alias("_file_path"),
        F.lit(0).cast("long").alias("_block_start"),
        F.lit(0).cast("long").alias("_line_order"),
    ]


def run_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Records that a run added, changed, removed or left, by their stored fingerprints."""
    path = scratch_path(spark, "runs")
    replace_run(_made_runs(spark, folder), path)
    return _plain(compare_runs(spark.read.parquet(path), "1", "2"))


def bucket_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Stored balances of customers after an upsert of some nations' customers into a bucketed table."""
    customer = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_nationkey", "c_acctbal")
    root, schema = scratch_path(spark, "balances"), "c_custkey bigint, c_nationkey int, balance decimal(12,2)"

    def rows(chosen: Column, factor: int) -> DataFrame:
        balance = (F.col("c_acctbal").cast("decimal(12,2)") * factor).cast("decimal(12,2)").alias("balance")
        made = customer.where(chosen).select(F.col("c_custkey").cast("long"), F.col("c_nationkey").cast("int"), balance)
        return pin(made, "balances")

    def merge(old: DataFrame, new: DataFrame, _: int) -> DataFrame:
        return upsert(old, new, ["c_custkey"])

    for chosen, factor in ((F.col("c_custkey") % 3 != 0, 1), (F.col("c_custkey") % 2 == 0, 2)):
        upsert_version(rows(chosen, factor), root, ["c_custkey"], merge, schema, buckets=16)
    stored = read_version(spark, root)
    return stored.select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey"), F.col("balance").cast("double").alias("balance"))


def appended_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by status in a table loaded in three overlapping parts: rows of known keys are not written again."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    root, loaded = scratch_path(spark, "orders"), []
    for low, high in ((0, 5), (3, 8), (3, 8)):
        rows = orders.where(F.col("o_orderkey") % 10 >= low).where(F.col("o_orderkey") % 10 < high)
        known = read_version(spark, root) if loaded else rows.limit(0)
        loaded.append(append_version(absent_rows(known, rows, ["o_orderkey"]), root))
    stored = read_version(spark, root)
    return stored.groupBy("o_orderstatus").agg(
        F.count("*").alias("row_count"),
        F.lit(loaded[1]).cast("long").alias("second_load"),
        F.lit(loaded[2]).cast("long").alias("third_load"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


def queries() -> dict[str, Query]:
    return {
        "spine_agg": spine_agg,
        "event_counts": event_counts,
        "panel_base": panel_base,
        "next_period_label": next_period_label,
        "rates": rates,
        "qoq_deltas": qoq_deltas,
        "rolling4": rolling4,
        "ss_share_lag": ss_share_lag,
        "deterioration_flag": deterioration_flag,
        "streak": streak,
        "features_full": features_full,
        "training_split": training_split,
        "dim_upsert": dim_upsert,
        "fact_insert_absent": fact_insert_absent,
        "fact_employment_load": _fact_load("employment", warehouse.employment_rows, warehouse.load_employment),
        "fact_incident_load": _fact_load("incident", warehouse.incident_rows, warehouse.load_incidents),
        "fact_violation_load": _fact_load("violation", warehouse.violation_rows, warehouse.load_violations),
        "fact_assessed_load": _fact_load("assessed_violation", warehouse.assessed_rows, warehouse.load_assessed),
        "constraint_report": constraint_report,
        "dq_base": dq_base,
        "dq_labels": dq_labels,
        "dq_features": dq_features,
        "score_checks": score_checks,
        "scaler_stats": scaler_stats,
        "stored_score_count": stored_score_count,
        "backtest_checks": backtest_checks,
        "rule_bounds": rule_bounds,
        "rule_scores": rule_scores,
        "rule_drivers": rule_drivers,
        "score_upsert": score_upsert,
        "logistic_scores": logistic_scores,
        "logistic_given": logistic_given,
        "logistic_optimality": logistic_optimality,
        "score_ranks": score_ranks,
        "topk_metrics": topk_metrics,
        "roc_auc": roc_auc,
        "avg_precision": avg_precision,
        "backtest_summary": backtest_summary,
        "rolling_backtest": rolling_backtest,
        "backtest_store": backtest_store,
        "quality_store": quality_store,
        "panel_refresh": panel_refresh,
        "kpi_summary": kpi_summary,
        "kpi_latest": kpi_latest,
        "kpi_listing": kpi_listing,
        "score_trend": score_trend,
        "top_risk": top_risk,
        "top_risk_listing": top_risk_listing,
        "entity_detail": entity_detail,
        "entity_detail_row": entity_detail_row,
        "entity_history": entity_history,
        "distinct_filters": distinct_filters,
        "value_counts": value_counts,
        "freshness": freshness,
        "clean_scalars": clean_scalars,
        **{f"staged_{d.name.removeprefix('msha_')}": _staged_query(d) for d in staging.DATASETS},
        "staging_statistics": staging_statistics,
        "staging_rejects": staging_rejects,
        "staging_faults": staging_faults,
        "run_changes": run_changes,
        "bucket_upsert": bucket_upsert,
        "appended_parts": appended_parts,
    }
