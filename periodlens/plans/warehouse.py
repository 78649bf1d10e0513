"""Staging rows to the dimension, fact, score and backtest tables.

Joins to the dimension carry no broadcast hint: Spark broadcasts it while its
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
shuffles, with AQE splitting the partitions of busy mines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.operators import checks, panel
from periodlens.operators.merge import absent_rows, insert_if_absent, upsert
from periodlens.plans import reports
from periodlens.session import drop_scratch, scratch_path
from periodlens.sources.tables import append_version, latest_run, read_parts, read_version, upsert_version
from periodlens.sources.tables import version_folders, version_notes, write_version

# Constants of the dimension.
SOURCE_SYSTEM = "MSHA"
COUNTRY_CODE = "US"

# Stored columns of each table.
MINE_SCHEMA = (
    "mine_key bigint, mine_id string, source_system string, mine_name string, country_code string, "
    "province_state string, commodity_group string, mine_type string, latitude decimal(10,6), "
    "longitude decimal(10,6), active_flag boolean, created_at timestamp, updated_at timestamp"
)
EMPLOYMENT_SCHEMA = (
    "ep_key bigint, mine_key bigint, year int, quarter int, period_key string, avg_employees decimal(12,2), "
    "employee_hours decimal(14,2), production_volume decimal(16,2), production_unit string, "
    "source_record_id string, load_ts timestamp"
)
INCIDENT_SCHEMA = (
    "incident_key bigint, mine_key bigint, incident_date date, incident_quarter string, incident_type string, "
    "severity_class string, lost_days int, days_restricted int, hours_worked_basis decimal(14,2), "
    "source_record_id string, load_ts timestamp"
)
VIOLATION_SCHEMA = (
    "violation_key bigint, mine_key bigint, inspection_event_no string, violation_date date, "
    "violation_quarter string, section_code string, likelihood_code string, negligence_code string, "
    "significant_substantial boolean, citation_order_flag string, source_record_id string, load_ts timestamp"
)
ASSESSED_SCHEMA = (
    "assessed_violation_key bigint, mine_key bigint, assessed_date date, assessed_quarter string, "
    "penalty_amount decimal(14,2), violation_reference_id string, source_record_id string, load_ts timestamp"
)
SCORE_SCHEMA = (
    "risk_score_key bigint, mine_key bigint, period_key string, model_version string, risk_score decimal(8,5), "
    "risk_band string, top_driver_1 string, top_driver_2 string, top_driver_3 string, label_next_period int, "
    "prediction_ts timestamp"
)
BACKTEST_SCHEMA = (
    "backtest_result_key bigint, backtest_run_id string, model_name string, model_version string, "
    "train_start_year int, train_end_year int, validation_year int, n_train_rows int, n_validation_rows int, "
    "n_validation_positives int, base_rate decimal(10,6), top_decile_size int, top_decile_positive_count int, "
    "roc_auc decimal(10,6), pr_auc decimal(10,6), precision_at_top_decile decimal(10,6), "
    "recall_at_top_decile decimal(10,6), lift_vs_base_rate decimal(10,6), created_at timestamp_ntz"
)
QUALITY_SCHEMA = (
    "dq_key bigint, run_id string, test_name string, entity_name string, status string, failure_count int, "
    "severity string, checked_at timestamp"
)

# Tables that the panel is built from.
FACTS = ("employment", "incident", "violation")

TABLES = {
    "mine": MINE_SCHEMA,
    "employment": EMPLOYMENT_SCHEMA,
    "incident": INCIDENT_SCHEMA,
    "violation": VIOLATION_SCHEMA,
    "assessed_violation": ASSESSED_SCHEMA,
    "risk_score": SCORE_SCHEMA,
    "backtest_result": BACKTEST_SCHEMA,
    "quality_result": QUALITY_SCHEMA,
}

# Names of the stored tables in quality results and the freshness report.
ENTITIES = {
    "mine": "dim_mine",
    "employment": "fact_msha_employment_production",
    "incident": "fact_msha_incident",
    "violation": "fact_msha_violation",
    "assessed_violation": "fact_msha_assessed_violation",
    "risk_score": "fact_risk_score",
    "backtest_result": "fact_backtest_result",
}

MINE_KEYS = ["mine_id", "source_system"]
SCORE_KEYS = ["mine_key", "period_key", "model_version"]
BACKTEST_KEYS = ["model_version", "validation_year"]


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def _stamp(moment: dt.datetime) -> Column:
    return F.lit(moment).cast("timestamp")


def mine_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("mine_id").isNotNull()).select(
        "mine_id",
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        "mine_name",
        F.lit(COUNTRY_CODE).alias("country_code"),
        "province_state",
        "commodity_group",
        "mine_type",
        "latitude",
        "longitude",
        F.lit(True).alias("active_flag"),
    )


def load_mines(target: DataFrame, staged: DataFrame, now: dt.datetime, highest: int | None = None) -> DataFrame:
    """Update known mines, NULLs included, and append new ones."""
    return upsert(
        target,
        mine_rows(staged),
        MINE_KEYS,
        on_insert={"created_at": _stamp(now), "updated_at": _stamp(now)},
        on_update={"updated_at": _stamp(now)},
        surrogate="mine_key",
        highest=highest,
    )


def _with_mine_key(staged: DataFrame, mines: DataFrame, *required: str) -> DataFrame:
    known = mines.where(F.col("source_system") == SOURCE_SYSTEM).select("mine_id", "mine_key")
    for name in ("mine_id", *required):
        staged = staged.where(F.col(name).isNotNull())
    return staged.join(known, "mine_id")


def employment_rows(staged: DataFrame, mines: DataFrame, now: dt.datetime) -> DataFrame:
    return _with_mine_key(staged, mines, "year", "quarter").select(
        "mine_key",
        "year",
        "quarter",
        "period_key",
        "avg_employees",
        "employee_hours",
        "production_volume",
        F.col("production_unit_raw").alias("production_unit"),
        "source_record_id",
        _stamp(now).alias("load_ts"),
    )


def incident_rows(staged: DataFrame, mines: DataFrame, now: dt.datetime) -> DataFrame:
    return _with_mine_key(staged, mines, "incident_date", "incident_quarter").select(
        "mine_key",
        "incident_date",
        "incident_quarter",
        F.col("incident_type_raw").alias("incident_type"),
        F.col("severity_class_raw").alias("severity_class"),
        "lost_days",
        "days_restricted",
        "hours_worked_basis",
        "source_record_id",
        _stamp(now).alias("load_ts"),
    )


def violation_rows(staged: DataFrame, mines: DataFrame, now: dt.datetime) -> DataFrame:
    return _with_mine_key(staged, mines, "violation_date", "violation_quarter").select(
        "mine_key",
        F.col("event_number").alias("inspection_event_no"),
        "violation_date",
        "violation_quarter",
        "section_code",
        "likelihood_code",
        "negligence_code",
        "significant_substantial",
        "citation_order_flag",
        "source_record_id",
        _stamp(now).alias("load_ts"),
    )


def assessed_rows(staged: DataFrame, mines: DataFrame, now: dt.datetime) -> DataFrame:
    return _with_mine_key(staged, mines).select(
        "mine_key",
        "assessed_date",
        "assessed_quarter",
        F.coalesce("assessment_amount", "proposed_penalty_amount").alias("penalty_amount"),
        F.col("violation_reference_raw").alias("violation_reference_id"),
        "source_record_id",
        _stamp(now).alias("load_ts"),
    )


#: Key and surrogate of each table whose rows are only ever added. The employment id covers the measures, so a revised
#: row is added beside the old one.
ADDED_TABLES = {
    "employment": (["mine_key", "year", "quarter", "source_record_id"], "ep_key"),
    "incident": (["source_record_id"], "incident_key"),
    "violation": (["source_record_id"], "violation_key"),
    "assessed_violation": (["source_record_id"], "assessed_violation_key"),
}


def load_employment(target: DataFrame, rows: DataFrame) -> DataFrame:
    return insert_if_absent(target, rows, *ADDED_TABLES["employment"])


def load_incidents(target: DataFrame, rows: DataFrame) -> DataFrame:
    return insert_if_absent(target, rows, *ADDED_TABLES["incident"])


def load_violations(target: DataFrame, rows: DataFrame) -> DataFrame:
    return insert_if_absent(target, rows, *ADDED_TABLES["violation"])


def load_assessed(target: DataFrame, rows: DataFrame) -> DataFrame:
    return insert_if_absent(target, rows, *ADDED_TABLES["assessed_violation"])


def store_scores(target: DataFrame, scores: DataFrame, now: dt.datetime, highest: int | None = None) -> DataFrame:
    """Upsert scores per mine, period and model version."""
    return upsert(
        target,
        scores.drop("prediction_ts"),
        SCORE_KEYS,
        on_insert={"prediction_ts": _stamp(now)},
        on_update={"prediction_ts": _stamp(now)},
        surrogate="risk_score_key",
        highest=highest,
    )


def store_backtest(target: DataFrame, results: DataFrame, now: dt.datetime, highest: int | None = None) -> DataFrame:
    """Upsert split metrics per model version and validation year."""
    stamp = _stamp(now).cast("timestamp_ntz")
    return upsert(
        target,
        results,
        BACKTEST_KEYS,
        on_insert={"created_at": stamp},
        on_update={"created_at": stamp},
        surrogate="backtest_result_key",
        highest=highest,
    )


def current_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """The newest version of a stored table; empty if it was never written."""
    try:
        return read_version(spark, f"{warehouse}/{name}")
    except FileNotFoundError:
        return empty_table(spark, name)


def record_checks(
    spark: SparkSession, warehouse: str, found: DataFrame, run_id: str, entity: str, now: dt.datetime
) -> dict[str, int]:
    """Store check rows as quality results, then raise if one of them failed; returns the statistics.

    Failures are stored too, before they stop the job. ``found`` has one row
    per check, which is all that reaches the driver.
    """
    counts = found.collect()
    rows = spark.createDataFrame(counts, found.schema)
    results = checks.quality_results(rows, run_id, entity, now)
    highest = current_table(spark, warehouse, "quality_result").agg(F.max("dq_key")).first()[0] or 0
    names = sorted(row.test_name for row in counts if not row.is_statistic)
    places = F.array_position(F.array(*[F.lit(name) for name in names]), F.col("test_name"))
    stored = results.withColumn("dq_key", places + F.lit(highest))
    columns = [F.col(c.name).cast(c.dataType) for c in empty_table(spark, "quality_result").schema]
    append_version(
        stored.select(*columns).coalesce(1),
        f"{warehouse}/quality_result",
        lambda df: checks.require_constraints(df, "quality_result"),
    )
    return checks.raise_on_counts(counts, entity)


def _constraint_check(
    spark: SparkSession, warehouse: str, table: str, run_id: str, now: dt.datetime, mines: DataFrame | None = None
) -> Callable[[DataFrame], None]:
    def check(df: DataFrame) -> None:
        report = checks.constraint_report(df, table, mines)
        try:
            record_checks(spark, warehouse, report, run_id, ENTITIES[table], now)
        except ValueError as error:
            raise ValueError(f"{table} violates constraints: {error}") from error

    return check


def save_scores(
    spark: SparkSession, warehouse: str, scores: DataFrame, now: dt.datetime, run_id: str = "scores", buckets: int = 64
) -> list[int]:
    """Upsert scores into the stored table and check its constraints; returns the buckets that were written."""
    return upsert_version(
        scores,
        f"{warehouse}/risk_score",
        SCORE_KEYS,
        lambda old, new, highest: store_scores(old, new, now, highest),
        SCORE_SCHEMA,
        "risk_score_key",
        _constraint_check(spark, warehouse, "risk_score", run_id, now),
        buckets,
    )


def save_backtest(
    spark: SparkSession, warehouse: str, results: DataFrame, now: dt.datetime, run_id: str = "backtest"
) -> list[int]:
    """Upsert split metrics into the stored table, one row for each model version and year, and check its constraints."""
    return upsert_version(
        results,
        f"{warehouse}/backtest_result",
        BACKTEST_KEYS,
        lambda old, new, highest: store_backtest(old, new, now, highest),
        BACKTEST_SCHEMA,
        "backtest_result_key",
        _constraint_check(spark, warehouse, "backtest_result", run_id, now),
        1,
    )


def run_panel(spark: SparkSession, warehouse: str, now: dt.datetime, run_id: str = "panel") -> DataFrame:
    """Build the panel from the stored facts, check it and make it the current one.

    The panel is written once, aside. Base, label and feature checks read it
    there and their results are stored; a failed check raises, and the panel
    that was current before stays so.
    """
    facts = [current_table(spark, warehouse, name) for name in FACTS]
    check = _panel_check(spark, warehouse, now, run_id)
    write_version(panel.build_panel(*facts), f"{warehouse}/mine_quarter", check)
    return read_version(spark, f"{warehouse}/mine_quarter")


def _panel_check(spark: SparkSession, warehouse: str, now: dt.datetime, run_id: str) -> Callable[[DataFrame], None]:
    """Base, label and feature checks of a panel, or of whole mines of it."""

    def check(whole: DataFrame) -> None:
        base, labels = panel.base_view(whole), panel.label_view(whole)
        features, training = panel.feature_view(whole), panel.training_view(whole)
        found = {
            "mine_quarter_base": checks.base_checks(base),
            "mine_quarter_labels": checks.label_checks(labels, base),
            "mine_quarter_features": checks.feature_checks(features, labels, training),
        }
        for entity, counts in found.items():
            record_checks(spark, warehouse, counts, run_id, entity, now)

    return check


def refresh_panel(
    spark: SparkSession, warehouse: str, now: dt.datetime, run_id: str = "panel", buckets: int = 64
) -> list[int]:
    """Bring the stored panel up to the stored facts; returns the buckets that were written.

    A panel remembers the fact parts it was built from. Mines that occur in
    parts added since are built anew from all their facts, with their windows,
    and only the buckets they fall into are written again, rows of other mines
    in them copied. All quarters of a mine share a bucket, so the checks, which
    see the buckets that are written, miss no pair of quarters. Facts are only
    ever added, so a mine loses no quarter; if parts have gone, or the stored
    panel is not kept in buckets, it is built whole.
    """
    root = f"{warehouse}/mine_quarter"
    parts = {name: _parts(spark, f"{warehouse}/{name}") for name in FACTS}
    seen = (version_notes(spark, root) or {}).get("built_from")
    whole = seen is None or any(set(seen[name]) - set(parts[name]) for name in FACTS)
    facts = [current_table(spark, warehouse, name) for name in FACTS]
    # Stored rows are counted in the file footers; those of the changed mines are no more.
    most = panel.fact_rows(*facts)
    scratch = [scratch_path(spark, label) for label in ("changed_mines", "refreshed_mines")]

    def stored(df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def merge(old: DataFrame, new: DataFrame, highest: int) -> DataFrame:
        if whole:  # there are no old rows
            return new
        return old.join(new.select("mine_key").distinct(), "mine_key", "left_anti").unionByName(new)

    try:
        if not whole:
            added = {name: [part for part in parts[name] if part not in seen[name]] for name in FACTS}
            if not any(added.values()):
                return []
            mines = [
                read_parts(spark, f"{warehouse}/{name}", new).select("mine_key") for name, new in added.items() if new
            ]
            changed = stored(reduce(DataFrame.union, mines).distinct(), scratch[0])
            facts = [fact.join(changed, "mine_key", "left_semi") for fact in facts]
        rows = stored(panel.build_panel(*facts, rows=most), scratch[1])
        return upsert_version(
            rows,
            root,
            ["mine_key"],
            merge,
            rows.schema,
            check=_panel_check(spark, warehouse, now, run_id),
            buckets=buckets,
            notes={"built_from": parts},
            whole=whole,
        )
    finally:
        for path in scratch:
            drop_scratch(spark, path)


def _parts(spark: SparkSession, root: str) -> list[str]:
    try:
        return version_folders(spark, root)
    except FileNotFoundError:
        return []


def stored_freshness(spark: SparkSession, warehouse: str, as_of: dt.datetime) -> DataFrame:
    """Freshness report over the stored tables and quality results."""
    sources = {entity: current_table(spark, warehouse, name) for name, entity in ENTITIES.items()}
    return reports.source_freshness(sources, current_table(spark, warehouse, "quality_result"), as_of)


def run_warehouse_load(
    spark: SparkSession, warehouse: str, now: dt.datetime, run_id: str | None = None, buckets: int = 64
) -> dict[str, int]:
    """Load one staged run, the newest by default; returns row counts added or updated.

    Mines are kept in buckets, of which only those that the run touches are
    written anew; the other tables get one more part with the rows they lack,
    and none if they lack none. New rows count only if they keep the table's
    constraints; else the load stops, and that table and the ones after it stay
    as they were. What the constraints found is stored as quality results.
    """

    def staged(table: str) -> DataFrame:
        return spark.read.parquet(f"{warehouse}/staging/{table}")

    run = run_id or latest_run(staged("stg_msha_mines"))

    def of_run(table: str) -> DataFrame:
        return staged(table).where(F.col("run_id") == run)

    rows = of_run("stg_msha_mines").where(F.col("mine_id").isNotNull()).withColumn("source_system", F.lit(SOURCE_SYSTEM))
    upsert_version(
        rows,
        f"{warehouse}/mine",
        MINE_KEYS,
        lambda old, new, highest: load_mines(old, new, now, highest),
        MINE_SCHEMA,
        "mine_key",
        _constraint_check(spark, warehouse, "mine", run, now),
        buckets,
    )
    mines = current_table(spark, warehouse, "mine")
    changed = {"mine": rows.count()}
    steps = {
        "employment": ("stg_msha_employment_production", employment_rows),
        "incident": ("stg_msha_incidents", incident_rows),
        "violation": ("stg_msha_violations", violation_rows),
        "assessed_violation": ("stg_msha_assessed_violations", assessed_rows),
    }
    for name, (table, to_rows) in steps.items():
        new = absent_rows(current_table(spark, warehouse, name), to_rows(of_run(table), mines, now), *ADDED_TABLES[name])
        changed[name] = append_version(
            new, f"{warehouse}/{name}", _constraint_check(spark, warehouse, name, run, now, mines)
        )
    return changed
