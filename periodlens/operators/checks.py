"""Data-quality checks and table constraints as counts of violating rows.

Rules are SQL predicates that describe a bad row. As in SQL, a predicate that
is NULL is not a violation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from periodlens.functions.period import PERIOD_PATTERN
from periodlens.operators.panel import LABEL

BANDS = "('Low', 'Medium', 'High', 'Critical')"
WRONG_PERIOD = "period_key <> concat(year, 'Q', quarter)"
NULL_KEYS = "mine_key IS NULL OR period_key IS NULL"
NULL_SCORE_KEYS = f"{NULL_KEYS} OR model_version IS NULL"


def count_violations(
    df: DataFrame,
    rules: Mapping[str, str],
    unique: Mapping[str, Sequence[str]] | None = None,
    statistics: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per check: ``test_name``, ``failure_count``, ``is_statistic``.

    Row rules and statistics take one pass. Each uniqueness check adds an
    aggregation on its key, with copies collapsed before the shuffle.
    """
    statistics = statistics or {}
    named = {**rules, **statistics}
    parts = []
    if named:
        counted = df.agg(*[F.expr(f"count_if({rule}) AS {name}") for name, rule in named.items()])
        entries = [
            f"struct('{name}' AS test_name, {name} AS failure_count, {str(name in statistics).lower()} AS is_statistic)"
            for name in named
        ]
        parts.append(counted.selectExpr(f"inline(array({', '.join(entries)}))"))
    for name, keys in (unique or {}).items():
        copies = df.groupBy(*keys).agg(F.expr("count(*) AS copies"))
        parts.append(
            copies.agg(F.expr("count_if(copies > 1) AS failure_count")).selectExpr(
                f"'{name}' AS test_name", "failure_count", "false AS is_statistic"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def row_count_delta(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` minus rows of ``right`` as one check row."""
    sides = left.selectExpr("1 AS side").unionByName(right.selectExpr("-1 AS side"))
    return sides.agg(F.expr("coalesce(sum(side), 0) AS failure_count")).selectExpr(
        f"'{name}' AS test_name", "failure_count", "false AS is_statistic"
    )


def base_checks(base: DataFrame) -> DataFrame:
    return count_violations(
        base,
        {
            "null_grain": NULL_KEYS,
            "invalid_quarter": "quarter NOT IN (1, 2, 3, 4)",
            "period_mismatch": WRONG_PERIOD,
            "negative_denominator": "avg_employees < 0 OR employee_hours < 0 OR production_volume < 0",
        },
        {"duplicate_grain": ["mine_key", "period_key"]},
        {"row_count": "true"},
    )


def label_checks(labels: DataFrame, base: DataFrame) -> DataFrame:
    exists, count = "next_quarter_exists_flag", "coalesce(next_quarter_incident_count, 0)"
    return count_violations(
        labels,
        {
            "null_keys": NULL_KEYS,
            "invalid_label_values": f"{LABEL} NOT IN (0, 1)",
            "invalid_exists_flag": f"{exists} NOT IN (0, 1)",
            "missing_next_but_nonnull_label": f"{exists} = 0 AND {LABEL} IS NOT NULL",
            "positive_logic_mismatch": f"{exists} = 1 AND {count} >= 1 AND {LABEL} <> 1",
            "negative_logic_mismatch": f"{exists} = 1 AND {count} = 0 AND {LABEL} <> 0",
            "invalid_next_period_key": f"next_period_key IS NULL OR NOT next_period_key RLIKE '{PERIOD_PATTERN}'",
        },
        {"duplicate_grain": ["mine_key", "period_key"]},
        {
            "label_null_count": f"{LABEL} IS NULL",
            "label_zero_count": f"{LABEL} = 0",
            "label_one_count": f"{LABEL} = 1",
        },
    ).unionByName(row_count_delta("row_count_delta_vs_base", base, labels))


def feature_checks(features: DataFrame, labels: DataFrame, training: DataFrame) -> DataFrame:
    checks = count_violations(
        features,
        {
            "null_keys": NULL_KEYS,
            "negative_rolling_counts": "feat_rolling_4q_incident_count < 0",
            "prior_incident_mismatch": "NOT feat_prior_incident_count <=> incident_count_prior_qtr",
        },
        {"duplicate_grain": ["mine_key", "period_key"]},
        {"feature_row_count": "true"},
    )
    trained = count_violations(
        training, {"training_null_label_count": f"{LABEL} IS NULL"}, statistics={"training_row_count": "true"}
    )
    return checks.unionByName(trained).unionByName(row_count_delta("row_count_delta_vs_labels", labels, features))


def score_checks(scored: DataFrame) -> DataFrame:
    """Checks on freshly scored rows, before they are stored."""
    return count_violations(
        scored,
        {
            "null_score": "risk_score IS NULL",
            "score_out_of_range": "risk_score < 0 OR risk_score > 1",
            "invalid_band": f"risk_band IS NULL OR risk_band NOT IN {BANDS}",
            "null_identifiers": NULL_SCORE_KEYS,
            "missing_top_driver_1": "top_driver_1 IS NULL",
        },
        statistics={"row_count": "true"},
    )


def stored_score_count(scores: DataFrame, training: DataFrame, model_version: str, year: int) -> DataFrame:
    """Stored rows of a model version that meet a training row of the year."""
    stored = scores.where(F.col("model_version") == model_version).select("mine_key", "period_key")
    wanted = training.where(F.col("year") == year).select("mine_key", "period_key")
    return stored.join(wanted, ["mine_key", "period_key"]).agg(F.count("*").alias("row_count"))


def backtest_checks(scored: DataFrame, validation_years: Sequence[int]) -> DataFrame:
    """Checks on the input of the backtest metrics."""
    years = ", ".join(str(int(year)) for year in validation_years)
    return count_violations(
        scored,
        {
            "unexpected_year": f"year IS NULL OR year NOT IN ({years})",
            "null_backtest_identifiers": NULL_SCORE_KEYS,
            "invalid_score": "risk_score IS NULL OR risk_score < 0 OR risk_score > 1",
            "invalid_label": "label_next_period IS NULL OR label_next_period NOT IN (0, 1)",
        },
    )


def raise_on_counts(counts: Sequence[Row], what: str) -> dict[str, int]:
    """Raise naming every failed check of collected check rows; return the statistics."""
    failures = {r.test_name: r.failure_count for r in counts if not r.is_statistic and r.failure_count != 0}
    if failures:
        raise ValueError(f"{what}: {failures}")
    return {r.test_name: r.failure_count for r in counts if r.is_statistic}


def raise_on_failures(checks: DataFrame, what: str) -> dict[str, int]:
    """Raise naming every failed check; return the statistics."""
    return raise_on_counts(checks.collect(), what)


def quality_results(checks: DataFrame, run_id: str, entity_name: str, checked_at: dt.datetime) -> DataFrame:
    """Check rows in the shape of the stored data-quality results."""
    failed = F.col("failure_count") != 0
    return checks.where("NOT is_statistic").select(
        F.lit(run_id).alias("run_id"),
        "test_name",
        F.lit(entity_name).alias("entity_name"),
        F.when(failed, "FAIL").otherwise("PASS").alias("status"),
        F.col("failure_count").cast("int").alias("failure_count"),
        F.when(failed, "CRITICAL").otherwise("LOW").alias("severity"),
        F.lit(checked_at).cast("timestamp").alias("checked_at"),
    )


def _not_null(*names: str) -> dict[str, str]:
    return {f"null_{name}": f"{name} IS NULL" for name in names}


def _non_negative(*names: str) -> dict[str, str]:
    return {f"negative_{name}": f"{name} < 0" for name in names}


def _valid_period(name: str) -> dict[str, str]:
    return {f"invalid_{name}": f"NOT {name} RLIKE '{PERIOD_PATTERN}'"}


# Row rules and unique keys of each stored table.
CONSTRAINTS: dict[str, tuple[dict[str, str], dict[str, list[str]]]] = {
    "mine": (_not_null("mine_id", "source_system"), {"duplicate_key": ["mine_id", "source_system"]}),
    "incident": (
        {
            **_not_null("mine_key", "incident_date", "incident_quarter", "source_record_id"),
            **_non_negative("lost_days", "days_restricted", "hours_worked_basis"),
            **_valid_period("incident_quarter"),
        },
        {"duplicate_key": ["source_record_id"]},
    ),
    "violation": (
        {
            **_not_null("mine_key", "violation_date", "violation_quarter", "source_record_id"),
            **_valid_period("violation_quarter"),
        },
        {"duplicate_key": ["source_record_id"]},
    ),
    "assessed_violation": (
        {
            **_not_null("mine_key", "source_record_id"),
            **_non_negative("penalty_amount"),
            **_valid_period("assessed_quarter"),
        },
        {"duplicate_key": ["source_record_id"]},
    ),
    "employment": (
        {
            **_not_null("mine_key", "year", "quarter", "period_key", "source_record_id"),
            **_non_negative("avg_employees", "employee_hours", "production_volume"),
            "invalid_quarter": "quarter NOT IN (1, 2, 3, 4)",
            "invalid_year": "year NOT BETWEEN 2000 AND 2100",
            "period_mismatch": WRONG_PERIOD,
        },
        {"duplicate_key": ["mine_key", "year", "quarter", "source_record_id"]},
    ),
    "quality_result": (
        {
            **_not_null("run_id", "test_name", "entity_name", "status", "checked_at"),
            **_non_negative("failure_count"),
            "invalid_status": "status NOT IN ('PASS', 'FAIL', 'WARN')",
            "invalid_severity": "severity NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')",
        },
        {},
    ),
    "risk_score": (
        {
            **_not_null("mine_key", "period_key", "model_version", "risk_score", "risk_band"),
            **_valid_period("period_key"),
            "score_out_of_range": "risk_score NOT BETWEEN 0 AND 1",
            "invalid_band": f"risk_band NOT IN {BANDS}",
            "invalid_label": "label_next_period NOT IN (0, 1)",
        },
        {"duplicate_key": ["mine_key", "period_key", "model_version"]},
    ),
    "backtest_result": (
        _not_null(
            "backtest_run_id",
            "model_name",
            "model_version",
            "train_start_year",
            "train_end_year",
            "validation_year",
            "n_train_rows",
            "n_validation_rows",
            "top_decile_size",
        ),
        {"duplicate_key": ["model_version", "validation_year"]},
    ),
}


def constraint_report(df: DataFrame, table: str, mines: DataFrame | None = None) -> DataFrame:
    """Violations of a table's constraints; with ``mines`` also unknown keys."""
    rules, unique = CONSTRAINTS[table]
    report = count_violations(df, rules, unique)
    if mines is None:
        return report
    # Keys are made distinct first, so a busy mine is one row in the join.
    keyed = df.where(F.col("mine_key").isNotNull()).groupBy("mine_key").agg(F.count("*").alias("rows"))
    orphans = keyed.join(mines.select("mine_key"), "mine_key", "left_anti")
    return report.unionByName(
        orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failure_count")).select(
            F.lit("unknown_mine_key").alias("test_name"), "failure_count", F.lit(False).alias("is_statistic")
        )
    )


def require_constraints(df: DataFrame, table: str, mines: DataFrame | None = None) -> None:
    """Raise, naming all of them, if constraints of a table are violated."""
    raise_on_failures(constraint_report(df, table, mines), f"{table} violates constraints")
