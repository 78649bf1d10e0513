"""Reporting views and their parameterised lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from periodlens.functions.numbers import age_hours, age_micros, guarded_ratio, model_family
from periodlens.functions.period import period_quarter, period_sort, period_year
from periodlens.functions.text import composite_key, fixed_digits
from periodlens.operators.metrics import model_summary
from periodlens.operators.ordering import rank_rows
from periodlens.operators.panel import FEATURES, LABEL
from periodlens.operators.scoring import DRIVER_COLUMNS
from periodlens.session import pin

MINE_COLUMNS = ("mine_id", "mine_name", "country_code", "province_state", "commodity_group", "mine_type")

# System and entity names, and the time column, of each source.
FRESHNESS_SOURCES = {
    "dim_mine": ("MSHA", "updated_at"),
    "fact_msha_incident": ("MSHA", "load_ts"),
    "fact_msha_violation": ("MSHA", "load_ts"),
    "fact_msha_assessed_violation": ("MSHA", "load_ts"),
    "fact_msha_employment_production": ("MSHA", "load_ts"),
    "fact_risk_score": ("MODEL", "prediction_ts"),
    "fact_backtest_result": ("MODEL", "created_at"),
}
FRESH_DAYS = 7
WARNING_DAYS = 30


def _scored(scores: DataFrame) -> DataFrame:
    return scores.withColumns(
        {
            "year": period_year(F.col("period_key")),
            "quarter": period_quarter(F.col("period_key")),
            "model_name": model_family(F.col("model_version")),
        }
    )


def _is_latest(latest: Column) -> Column:
    sort = period_sort(F.col("year"), F.col("quarter"))
    return F.coalesce((sort == latest).cast("int"), F.lit(0))


def kpi_summary(scores: DataFrame) -> DataFrame:
    """Counts, score statistics and flag quality per model version and period.

    The exact median keeps one counter per distinct score; stored scores have
    five decimals in [0, 1], so at most 100,001 counters per group.
    """
    high, critical = F.col("risk_band") == "High", F.col("risk_band") == "Critical"
    positive = F.col("label_next_period") == 1
    summed = (
        _scored(scores)
        .groupBy("model_name", "model_version", "period_key", "year", "quarter")
        .agg(
            F.count("*").alias("total_mines_scored"),
            (F.sum("risk_score").cast("double") / F.count("risk_score")).alias("avg_risk_score"),
            F.percentile("risk_score", 0.5).alias("median_risk_score"),
            F.max("risk_score").alias("max_risk_score"),
            F.count_if(high).alias("high_risk_mine_count"),
            F.count_if(critical).alias("critical_risk_mine_count"),
            F.count_if(high | critical).alias("high_or_critical_risk_mine_count"),
            F.count_if(positive).alias("actual_positive_count"),
            F.count_if((high | critical) & positive).alias("flagged_positive_count"),
        )
    )
    # One row per period here, so a model has few rows.
    latest = F.max(period_sort(F.col("year"), F.col("quarter"))).over(Window.partitionBy("model_version"))
    flagged = F.col("high_or_critical_risk_mine_count")
    return summed.withColumn("is_latest_period_for_model_flag", _is_latest(latest)).select(
        composite_key(F.col("model_version"), F.col("period_key")).alias("summary_key"),
        "model_name",
        "model_version",
        "period_key",
        "year",
        "quarter",
        "is_latest_period_for_model_flag",
        "total_mines_scored",
        "avg_risk_score",
        "median_risk_score",
        "max_risk_score",
        "high_risk_mine_count",
        "critical_risk_mine_count",
        "high_or_critical_risk_mine_count",
        guarded_ratio(flagged, F.col("total_mines_scored")).alias("high_or_critical_risk_share"),
        "actual_positive_count",
        "flagged_positive_count",
        guarded_ratio(F.col("flagged_positive_count"), flagged).alias("flagged_positive_precision"),
    )


def kpi_listing(kpis: DataFrame) -> DataFrame:
    return kpis.drop("summary_key").orderBy("model_version", "year", "quarter")


def latest_kpi(kpis: DataFrame) -> DataFrame:
    """Newest period of the first model; flagged latest periods come first."""
    return kpis.orderBy(
        F.desc("is_latest_period_for_model_flag"), "model_version", F.desc("year"), F.desc("quarter")
    ).limit(1)


def score_trend(kpis: DataFrame, model_version: str) -> DataFrame:
    chosen = kpis.where(F.col("model_version") == model_version)
    return chosen.select("period_key", "year", "quarter", "avg_risk_score").orderBy("year", "quarter")


def _row_key() -> Column:
    return composite_key(F.col("model_version"), F.col("period_key"), F.col("mine_key"))


def top_risk(
    scores: DataFrame,
    mines: DataFrame,
    features: DataFrame,
    model_version: str | None = None,
    period_key: str | None = None,
) -> DataFrame:
    """Rank of each mine within its model version and period.

    Ranks belong to one (model version, period), so these two filters may be
    given here and are applied before ranking; all others come after.
    """
    chosen = scores
    if model_version:
        chosen = chosen.where(F.col("model_version") == model_version)
    if period_key:
        chosen = chosen.where(F.col("period_key") == period_key)
    ranked = rank_rows(
        chosen,
        ["model_version", "period_key"],
        [F.desc("risk_score"), "mine_key"],
        "risk_rank",
        "_group_rows",
    )
    percent = F.coalesce(guarded_ratio(F.col("risk_rank") - 1, F.col("_group_rows") - 1), F.lit(0.0))
    measures = features.select(
        "mine_key",
        "period_key",
        "employee_hours",
        "production_volume",
        "incident_count_current_qtr",
        "violation_count_current_qtr",
        LABEL,
    )
    periods = _scored(scores).groupBy("model_version")
    latest = pin(periods.agg(F.max(period_sort(F.col("year"), F.col("quarter"))).alias("_latest")), "latest")
    joined = (
        _scored(ranked)
        .join(latest, "model_version", "left")
        .withColumn("is_latest_period_for_model_flag", _is_latest(F.col("_latest")))
        .withColumn("risk_percent_rank", percent)
        .join(mines.select("mine_key", *MINE_COLUMNS), "mine_key", "left")
        .join(measures, ["mine_key", "period_key"], "left")
    )
    return joined.select(
        _row_key().alias("mine_period_model_key"),
        composite_key(F.col("model_version"), F.col("period_key")).alias("summary_key"),
        "model_name",
        "model_version",
        "period_key",
        "year",
        "quarter",
        "is_latest_period_for_model_flag",
        "mine_key",
        *MINE_COLUMNS,
        "risk_rank",
        "risk_percent_rank",
        "risk_score",
        "risk_band",
        *DRIVER_COLUMNS,
        "employee_hours",
        "production_volume",
        "incident_count_current_qtr",
        "violation_count_current_qtr",
        LABEL,
    )


def top_risk_listing(top: DataFrame, filters: Mapping[str, str] | None = None, limit: int = 500) -> DataFrame:
    """The highest scores that meet the equality filters; ranks stay as they were."""
    allowed = ("model_version", "period_key", "province_state", "commodity_group", "risk_band")
    for name, value in (filters or {}).items():
        if name not in allowed:
            raise ValueError(f"cannot filter on {name}")
        if value:
            top = top.where(F.col(name) == value)
    return top.orderBy(F.desc("risk_score"), "mine_key").limit(limit).select(
        "model_version",
        "period_key",
        "mine_key",
        "mine_id",
        "mine_name",
        "province_state",
        "commodity_group",
        "mine_type",
        "risk_rank",
        "risk_score",
        "risk_band",
        *DRIVER_COLUMNS,
        "employee_hours",
        "production_volume",
        "incident_count_current_qtr",
        "violation_count_current_qtr",
        LABEL,
    )


def mine_detail(scores: DataFrame, mines: DataFrame, panel: DataFrame) -> DataFrame:
    """Scores with mine attributes and the full panel row."""
    panel_columns = (
        "avg_employees",
        "employee_hours",
        "production_volume",
        "production_unit",
        "incident_count_current_qtr",
        "incident_count_prior_qtr",
        "violation_count_current_qtr",
        "violation_count_prior_qtr",
        "assessed_penalty_amount_current_qtr",
        "assessed_penalty_amount_prior_qtr",
        "lost_day_incident_count_current_qtr",
        "ss_violation_count_current_qtr",
        "incident_rate_per_200k_hours_current_qtr",
        "violation_rate_per_10k_hours_current_qtr",
        "production_per_employee_hour_current_qtr",
        "incident_rate_qoq_delta",
        "deterioration_flag_current_qtr",
        *FEATURES,
    )
    joined = (
        _scored(scores)
        .join(panel.select("mine_key", "period_key", *panel_columns), ["mine_key", "period_key"], "left")
        .join(mines.select("mine_key", *MINE_COLUMNS), "mine_key", "left")
    )
    return joined.select(
        _row_key().alias("mine_period_model_key"),
        composite_key(F.col("model_version"), F.col("period_key")).alias("summary_key"),
        "model_name",
        "model_version",
        "period_key",
        "year",
        "quarter",
        "mine_key",
        *MINE_COLUMNS,
        "risk_score",
        "risk_band",
        *DRIVER_COLUMNS,
        "label_next_period",
        *panel_columns,
    )


def detail_row(detail: DataFrame, model_version: str, period_key: str, mine_id: str) -> DataFrame:
    return detail.where(
        (F.col("model_version") == model_version)
        & (F.col("period_key") == period_key)
        & (F.col("mine_id") == mine_id)
    ).limit(1)


def mine_history(detail: DataFrame, model_version: str, mine_id: str) -> DataFrame:
    chosen = detail.where((F.col("model_version") == model_version) & (F.col("mine_id") == mine_id))
    return chosen.select(
        "period_key",
        "year",
        "quarter",
        "incident_count_current_qtr",
        "violation_count_current_qtr",
        "production_per_employee_hour_current_qtr",
    ).orderBy("year", "quarter")


def choices(view: DataFrame, *names: str) -> DataFrame:
    """Distinct values to choose from, ordered; rows without a first value drop out."""
    return view.where(F.col(names[0]).isNotNull()).select(*names).distinct().orderBy(*names)


def top_risk_choices(top: DataFrame) -> dict[str, DataFrame]:
    names = {
        "model_versions": "model_version",
        "periods": "period_key",
        "states": "province_state",
        "commodities": "commodity_group",
        "risk_bands": "risk_band",
    }
    return {label: choices(top, name) for label, name in names.items()}


def mine_detail_choices(detail: DataFrame) -> dict[str, DataFrame]:
    return {
        "model_versions": choices(detail, "model_version"),
        "periods": choices(detail, "period_key"),
        "mines": choices(detail, "mine_id", "mine_name"),
    }


def value_counts(view: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; ties by value."""
    counts = view.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("row_count"))
    ordered = counts.orderBy(F.desc("row_count"), name)
    return ordered.limit(limit) if limit else ordered


def business_claim(capture: Column, lift: Column, unknown: str) -> Column:
    """Sentence on the share of incidents caught; ``unknown`` ends the NULL case."""
    caught = F.concat(
        F.col("model_name"),
        F.lit(": top 10% highest-risk mines captured "),
        fixed_digits(capture * 100, 1),
        F.lit("% of next-quarter incidents"),
    )
    return (
        F.when(capture.isNull(), F.concat(F.col("model_name"), F.lit(unknown)))
        .when(lift.isNull(), F.concat(caught, F.lit(".")))
        .otherwise(F.concat(caught, F.lit(" at "), fixed_digits(lift, 2), F.lit("x the base rate.")))
    )


def claims(summary: DataFrame) -> DataFrame:
    """One sentence per model, for the text report of a backtest run."""
    sentence = business_claim(
        F.col("pooled_recall_at_top_decile"),
        F.col("pooled_lift_vs_base_rate"),
        ": capture rate at top decile could not be computed.",
    )
    return summary.orderBy("model_name").select(sentence.alias("claim"))


def backtest_summary(results: DataFrame) -> DataFrame:
    """Stored split metrics with the summary and the claim of their model."""
    summary = model_summary(results).withColumnRenamed("n_splits", "n_splits_for_model")
    claim = business_claim(
        F.col("pooled_recall_at_top_decile"),
        F.col("pooled_lift_vs_base_rate"),
        ": pooled capture rate could not be computed.",
    )
    return results.join(summary, "model_name", "left").select(
        composite_key(F.col("model_version"), F.col("validation_year")).alias("model_validation_key"),
        "model_name",
        "model_version",
        "validation_year",
        "train_start_year",
        "train_end_year",
        "n_train_rows",
        "n_validation_rows",
        "n_validation_positives",
        "base_rate",
        "top_decile_size",
        "top_decile_positive_count",
        "roc_auc",
        "pr_auc",
        "precision_at_top_decile",
        "recall_at_top_decile",
        "lift_vs_base_rate",
        *[name for name in summary.columns if name != "model_name"],
        claim.alias("business_claim_text"),
    )


def backtest_listing(view: DataFrame) -> DataFrame:
    return view.drop("model_validation_key").orderBy("model_version", "validation_year")


def yearly_metrics(view: DataFrame) -> DataFrame:
    """Split metrics by validation year, each distinct row once."""
    return view.select(
        "validation_year",
        "roc_auc",
        "pr_auc",
        "precision_at_top_decile",
        "recall_at_top_decile",
        "lift_vs_base_rate",
        "business_claim_text",
    ).dropDuplicates()


def pooled_metrics(view: DataFrame) -> DataFrame:
    """Pooled ratios of the first listed split that has all three."""
    names = ["pooled_precision_at_top_decile", "pooled_recall_at_top_decile", "pooled_lift_vs_base_rate"]
    return view.dropna(subset=names).orderBy("model_version", "validation_year").select(*names).limit(1)


def source_freshness(
    sources: Mapping[str, DataFrame], quality: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """Row count, age and latest quality status per stored table."""
    loads = [
        sources[name]
        .agg(F.max(F.col(column).cast("timestamp")).alias("latest_data_ts"), F.count("*").alias("row_count"))
        .select(
            F.lit(system).alias("source_system"), F.lit(name).alias("entity_name"), "latest_data_ts", "row_count"
        )
        for name, (system, column) in FRESHNESS_SOURCES.items()
    ]
    newest = F.struct("checked_at", "dq_key")
    checked = quality.groupBy("entity_name").agg(
        F.max("checked_at").alias("latest_quality_check_ts"),
        F.max_by("status", newest).alias("latest_quality_status"),
        F.max_by("severity", newest).alias("latest_quality_severity"),
    )
    now, moment = F.lit(as_of).cast("timestamp"), F.col("latest_data_ts")
    age = age_micros(now, moment)
    day = 24 * 3600 * 1000000
    status = (
        F.when(moment.isNull(), "Missing")
        .when(age <= FRESH_DAYS * day, "Fresh")
        .when(age <= WARNING_DAYS * day, "Warning")
        .otherwise("Stale")
    )
    return (
        reduce(DataFrame.unionByName, loads)
        .join(checked, "entity_name", "left")
        .select(
            composite_key(F.col("source_system"), F.col("entity_name")).alias("governance_key"),
            "source_system",
            "entity_name",
            "row_count",
            "latest_data_ts",
            "latest_quality_check_ts",
            "latest_quality_status",
            "latest_quality_severity",
            age_hours(now, moment).alias("freshness_age_hours"),
            status.alias("freshness_status"),
        )
    )


def freshness_listing(view: DataFrame) -> DataFrame:
    return view.drop("governance_key").orderBy("source_system", "entity_name")
