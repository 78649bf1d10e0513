"""Raw files to typed staging rows: one declarative spec per data set."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.functions import text
from periodlens.functions.period import period_key, period_of_date
from periodlens.operators.merge import first_per_key, require_unique
from periodlens.session import pin, small_methods
from periodlens.sources.delimited import (
    FILE_ORDER,
    TOO_MANY_FIELDS,
    UNBALANCED_QUOTES,
    data_columns,
    read_delimited,
    require_columns,
    resolve,
)
from periodlens.sources.tables import read_manifest, replace_run, require_datasets

# All take cleaned texts.
_PARSERS: dict[str, Callable[[Column, bool], Column]] = {
    "text": lambda cleaned, _: cleaned,
    "int": text.parse_int,
    "decimal": text.parse_decimal,
    "date": text.parse_date,
    "bool": text.parse_bool,
}

# A bad value of these kinds rejects the row; a bad date or flag is NULL.
_STRICT_KINDS = ("int", "decimal")


@dataclass(frozen=True)
class Field:
    """A field of a data set: where to find it and how to type it."""

    name: str
    headers: tuple[str, ...]
    kind: str = "text"
    required: bool = False
    non_negative: bool = False
    allowed: tuple[int, ...] = ()
    stored: str | None = None
    """Type of the stored column where a typed value may not fit it."""


@dataclass(frozen=True)
class Dataset:
    """Staging rules of a data set.

    ``columns`` builds the stored columns from raw texts and typed values.
    ``keep_first`` drops later rows with the same id instead of failing.
    """

    name: str
    table: str
    fields: tuple[Field, ...]
    header_required: tuple[str, ...]
    columns: Callable[[Mapping[str, Column], Mapping[str, Column]], dict[str, Column]]
    keep_first: bool = False
    required: bool = True


@dataclass(frozen=True)
class Staged:
    accepted: DataFrame
    rejected: DataFrame
    statistics: DataFrame


# Header candidates in order of preference.
_MINE_ID = Field("mine_id", ("mine_id", "mineid"), required=True)


def _mine_columns(raw: Mapping[str, Column], value: Mapping[str, Column]) -> dict[str, Column]:
    copies = ("mine_id", "mine_name", "status", "state", "commodity", "mine_type", "latitude", "longitude")
    return {
        "source_record_id": value["mine_id"],
        **{f"{name}_raw": raw[name] for name in copies},
        "mine_id": value["mine_id"],
        "mine_name": value["mine_name"],
        "status": value["status"],
        "province_state": value["state"],
        "commodity_group": value["commodity"],
        "mine_type": value["mine_type"],
        "latitude": value["latitude"].cast("decimal(10,6)"),
        "longitude": value["longitude"].cast("decimal(10,6)"),
    }


MINES = Dataset(
    "msha_mines",
    "stg_msha_mines",
    (
        _MINE_ID,
        Field("mine_name", ("mine_name", "mine_name_raw", "mine_name_txt")),
        Field("status", ("current_status", "status", "mine_status", "current_status_cd")),
        Field("state", ("state", "state_abbr", "state_cd", "province_state")),
        Field("commodity", ("primary_commodity", "commodity", "primary_commodity_cd", "commodity_cd")),
        Field("mine_type", ("mine_type", "mine_type_cd", "mine_type_desc", "mine_type_raw")),
        Field("latitude", ("latitude", "lat"), "decimal", stored="decimal(10,6)"),
        Field("longitude", ("longitude", "lon", "long"), "decimal", stored="decimal(10,6)"),
    ),
    ("mine_id",),
    _mine_columns,
)


def _employment_columns(raw: Mapping[str, Column], value: Mapping[str, Column]) -> dict[str, Column]:
    measures = ("avg_employees", "employee_hours", "production_volume")
    record = text.record_id(
        [
            value["mine_id"],
            value["year"],
            value["quarter"],
            value["subunit_code"],
            *[text.decimal_id_text(raw[name], value[name]) for name in measures],
            value["production_unit"],
        ]
    )
    return {
        "source_record_id": record,
        "mine_id": value["mine_id"],
        "year": value["year"],
        "quarter": value["quarter"],
        "period_key": period_key(value["year"], value["quarter"]),
        "subunit_code": value["subunit_code"],
        "avg_employees": value["avg_employees"].cast("decimal(12,2)"),
        "employee_hours": value["employee_hours"].cast("decimal(14,2)"),
        "production_volume": value["production_volume"].cast("decimal(16,2)"),
        "production_unit_raw": value["production_unit"],
    }


EMPLOYMENT = Dataset(
    "msha_employment_production_quarterly",
    "stg_msha_employment_production",
    (
        _MINE_ID,
        Field("year", ("cal_yr", "year"), "int", required=True),
        Field("quarter", ("cal_qtr", "quarter"), "int", required=True, allowed=(1, 2, 3, 4)),
        Field("subunit_code", ("subunit_cd", "subunit_code", "subunit")),
        Field(
            "avg_employees",
            ("avg_employees", "avg_employee", "avg_emp", "avg_employment"),
            "decimal",
            non_negative=True,
            stored="decimal(12,2)",
        ),
        Field("employee_hours", ("employee_hours", "emp_hours", "hours_worked"), "decimal", non_negative=True, stored="decimal(14,2)"),
        Field(
            "production_volume",
            ("production", "production_volume", "prod_tons", "total_production"),
            "decimal",
            non_negative=True,
            stored="decimal(16,2)",
        ),
        Field("production_unit", ("production_unit", "prod_unit", "unit")),
    ),
    ("mine_id", "year", "quarter", "subunit_code"),
    _employment_columns,
)


def _incident_columns(raw: Mapping[str, Column], value: Mapping[str, Column]) -> dict[str, Column]:
    return {
        "source_record_id": value["document_number"],
        "document_number": value["document_number"],
        "mine_id": value["mine_id"],
        "incident_date_raw": raw["incident_date"],
        "incident_date": value["incident_date"],
        "incident_quarter": period_of_date(value["incident_date"]),
        "incident_type_raw": value["incident_type"],
        "severity_class_raw": value["severity_class"],
        "lost_days": value["lost_days"],
        "days_restricted": value["days_restricted"],
        "hours_worked_basis": value["hours_worked_basis"].cast("decimal(14,2)"),
    }


INCIDENTS = Dataset(
    "msha_incidents",
    "stg_msha_incidents",
    (
        Field("document_number", ("document_number", "document_no", "document_num"), required=True),
        _MINE_ID,
        Field("incident_date", ("accident_dt", "incident_date", "accident_date"), "date", required=True),
        Field("incident_type", ("accident_class", "incident_type", "accident_type", "occurrence_type")),
        Field("severity_class", ("severity", "injury_severity", "degree_injury", "severity_class")),
        Field("lost_days", ("lost_days", "lost_workdays", "lost_workday_cnt"), "int", non_negative=True),
        Field(
            "days_restricted",
            ("days_restricted", "restricted_workdays", "restricted_workday_cnt"),
            "int",
            non_negative=True,
        ),
        Field(
            "hours_worked_basis",
            ("hours_worked", "hours_worked_basis", "employee_hours"),
            "decimal",
            non_negative=True,
            stored="decimal(14,2)",
        ),
    ),
    ("document_number", "mine_id", "incident_date"),
    _incident_columns,
)


def _violation_columns(raw: Mapping[str, Column], value: Mapping[str, Column]) -> dict[str, Column]:
    parts = ("mine_id", "event_number", "violation_no", "violation_date", "section_code", "citation_order_flag")
    return {
        "source_record_id": text.record_id([value[name] for name in parts]),
        "mine_id": value["mine_id"],
        "event_number": value["event_number"],
        "violation_no_raw": value["violation_no"],
        "violation_date_raw": raw["violation_date"],
        "violation_date": value["violation_date"],
        "violation_quarter": period_of_date(value["violation_date"]),
        "section_code": value["section_code"],
        "likelihood_code": value["likelihood_code"],
        "negligence_code": value["negligence_code"],
        "significant_substantial": value["significant_substantial"],
        "citation_order_flag": value["citation_order_flag"],
    }


VIOLATIONS = Dataset(
    "msha_violations",
    "stg_msha_violations",
    (
        _MINE_ID,
        Field("event_number", ("event_no", "event_number", "inspection_event_no")),
        Field("violation_no", ("violation_no", "violation_number", "violation_id")),
        Field(
            "violation_date",
            ("violation_issue_dt", "violation_date", "violation_dt", "violation_occur_dt"),
            "date",
            required=True,
        ),
        Field("section_code", ("section_code", "section", "section_citation", "section_cd")),
        Field("likelihood_code", ("likelihood", "likelihood_code", "likelihood_cd")),
        Field("negligence_code", ("negligence", "negligence_code", "negligence_cd")),
        Field("significant_substantial", ("s_and_s", "significant_substantial", "sig_sub"), "bool"),
        Field("citation_order_flag", ("citation_order", "citation_order_flag", "citation_or_order")),
    ),
    ("mine_id", "violation_date"),
    _violation_columns,
    keep_first=True,
)


def _assessed_columns(raw: Mapping[str, Column], value: Mapping[str, Column]) -> dict[str, Column]:
    record = text.record_id(
        [
            value["mine_id"],
            value["assessment_case_no"],
            value["section_code"],
            raw["assessed_date"],
            text.decimal_id_text(raw["proposed_penalty_amount"], value["proposed_penalty_amount"]),
        ]
    )
    amounts = ("proposed_penalty_amount", "assessment_amount", "interest_amount")
    return {
        "source_record_id": record,
        "mine_id": value["mine_id"],
        "assessment_case_no": value["assessment_case_no"],
        "assessed_date_raw": raw["assessed_date"],
        "assessed_date": value["assessed_date"],
        "assessed_quarter": period_of_date(value["assessed_date"]),
        "section_code": value["section_code"],
        **{name: value[name].cast("decimal(14,2)") for name in amounts},
        "case_status_raw": value["case_status"],
        "violation_reference_raw": value["violation_reference"],
    }


ASSESSED = Dataset(
    "msha_assessed_violations",
    "stg_msha_assessed_violations",
    (
        _MINE_ID,
        Field(
            "assessment_case_no",
            ("assessment_case_no", "assessment_case_number", "case_no", "case_number"),
        ),
        Field(
            "assessed_date",
            (
                "assessed_date",
                "assessment_date",
                "assess_case_status_dt",
                "issue_dt",
                "occurrence_dt",
                "final_order_dt",
                "bill_print_dt",
            ),
            "date",
        ),
        Field("section_code", ("section_code", "section", "section_cd", "mine_act_section")),
        Field(
            "proposed_penalty_amount",
            ("proposed_penalty_amount", "proposed_penalty", "proposed_penalty_amt"),
            "decimal",
            non_negative=True,
            stored="decimal(14,2)",
        ),
        Field(
            "assessment_amount",
            ("assessment_amount", "assessed_amount", "assessment_amt"),
            "decimal",
            non_negative=True,
            stored="decimal(14,2)",
        ),
        Field("interest_amount", ("interest_amount", "interest_amt"), "decimal", non_negative=True, stored="decimal(14,2)"),
        Field("case_status", ("case_status", "case_status_cd", "assess_case_status")),
        Field(
            "violation_reference",
            ("violation_no", "violation_number", "violation_reference", "violation_id"),
        ),
    ),
    ("mine_id", "assessed_date"),
    _assessed_columns,
)

# Load order.
DATASETS = (MINES, EMPLOYMENT, INCIDENTS, VIOLATIONS, ASSESSED)


def _reject_reason(
    dataset: Dataset, raw: Mapping[str, Column], value: Mapping[str, Column], header_required: tuple[str, ...]
) -> Column:
    """First reason to refuse a row, NULL for a good one."""
    reasons = [
        F.when(F.col(UNBALANCED_QUOTES), "unbalanced quotes"),
        F.when(F.col(TOO_MANY_FIELDS), "too many fields"),
    ]
    for field in dataset.fields:
        given, typed = raw[field.name], value[field.name]
        # A date is mandatory per row when its column is mandatory.
        required = field.required or (field.kind == "date" and field.name in header_required)
        if field.kind in _STRICT_KINDS:
            reasons.append(F.when(given.isNotNull() & typed.isNull(), f"invalid {field.name}"))
        if required:
            reasons.append(F.when(typed.isNull(), f"missing {field.name}"))
        if field.non_negative:
            reasons.append(F.when(typed < 0, f"negative {field.name}"))
        if field.stored:
            reasons.append(
                F.when(typed.isNotNull() & typed.try_cast(field.stored).isNull(), f"out of range {field.name}")
            )
        if field.allowed:
            reasons.append(F.when(~typed.isin(*field.allowed), f"invalid {field.name}"))
    return F.coalesce(*reasons)


def type_rows(
    raw_rows: DataFrame,
    dataset: Dataset,
    run_id: str,
    source_file_name: str,
    ingested_at: dt.datetime,
    header_required: tuple[str, ...] | None = None,
) -> DataFrame:
    """Typed columns, ``reject_reason`` and file position of every raw row.

    Each raw text is cleaned once and each value typed once, as columns.
    """
    header_required = dataset.header_required if header_required is None else header_required
    require_columns(raw_rows, header_required, {f.name: f.headers for f in dataset.fields})
    cleaned = raw_rows.withColumns(
        {f"_raw_{f.name}": text.clean_text(resolve(raw_rows, f.headers)) for f in dataset.fields}
    )
    raw = {f.name: F.col(f"_raw_{f.name}") for f in dataset.fields}
    typed = cleaned.withColumns({f"_value_{f.name}": _PARSERS[f.kind](raw[f.name], True) for f in dataset.fields})
    value = {f.name: F.col(f"_value_{f.name}") for f in dataset.fields}
    judged = typed.withColumn("reject_reason", _reject_reason(dataset, raw, value, header_required))
    accepted = F.col("reject_reason").isNull()
    # Stored columns are only computed for accepted rows: a refused value may
    # not fit its stored type.
    stored = {
        name: F.when(accepted, column).alias(name) for name, column in dataset.columns(raw, value).items()
    }
    return judged.select(
        F.lit(run_id).alias("run_id"),
        *stored.values(),
        text.row_fingerprint(data_columns(raw_rows)).alias("row_hash"),
        F.lit(source_file_name).alias("source_file_name"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
        "reject_reason",
        *FILE_ORDER,
    )


def stage_rows(
    raw_rows: DataFrame,
    dataset: Dataset,
    run_id: str,
    source_file_name: str,
    ingested_at: dt.datetime,
    header_required: tuple[str, ...] | None = None,
    on_too_many_fields: str = "fail",
) -> Staged:
    """Split raw rows into accepted and rejected ones, with load statistics.

    A row with too many fields or unbalanced quotes fails the data set, or with
    ``on_too_many_fields="quarantine"`` is rejected like any other bad row.
    """
    typed = type_rows(raw_rows, dataset, run_id, source_file_name, ingested_at, header_required)
    with small_methods(raw_rows.sparkSession):
        rows = pin(typed, dataset.table)
    rejected = rows.where(F.col("reject_reason").isNotNull())
    if on_too_many_fields == "fail":
        first = rejected.where("reject_reason IN ('too many fields', 'unbalanced quotes')").head(1)
        if first:
            raise ValueError(
                f"{dataset.name}: {first[0]['reject_reason']} in {first[0]['_file_path']}; "
                "a quote is not closed, or its line holds more fields than the header"
            )
    accepted = rows.where(F.col("reject_reason").isNull()).drop("reject_reason")
    if dataset.keep_first:
        accepted = first_per_key(accepted, ["source_record_id"], FILE_ORDER)
    else:
        require_unique(accepted, ["source_record_id"], dataset.name)
    accepted = accepted.drop(*FILE_ORDER)
    good = F.col("reject_reason").isNull()
    loaded = F.count_if(good)
    if dataset.keep_first:
        loaded = F.count_distinct(F.when(good, F.col("source_record_id")))
    counted = rows.agg(
        F.count("*").alias("rows_read"), loaded.alias("rows_loaded"), F.count_if(~good).alias("rows_rejected")
    )
    statistics = counted.select(
        F.lit(run_id).alias("run_id"),
        F.lit(dataset.name).alias("dataset_name"),
        F.lit(dataset.table).alias("stage_table"),
        F.lit(source_file_name).alias("source_file_name"),
        "rows_read",
        "rows_loaded",
        "rows_rejected",
        F.when(F.col("rows_rejected") == 0, "SUCCESS").otherwise("WARN").alias("status"),
    )
    return Staged(accepted, rejected, statistics)


def load_run(
    spark: SparkSession,
    run_folder: str,
    warehouse: str,
    run_id: str,
    ingested_at: dt.datetime,
    delimiter: str = "|",
    encoding: str = "ISO-8859-1",
    on_too_many_fields: str = "fail",
    datasets: tuple[Dataset, ...] = DATASETS,
) -> list[dict]:
    """Stage every data set of a run in order; returns one summary per data set.

    A failing required data set stops the run; an optional one is skipped, and
    its summary has the status FAILED and the reason in ``error``. Summaries
    have the seconds a data set took in ``duration_seconds``.
    """
    manifest = read_manifest(spark, f"{run_folder}/manifest.json")
    require_datasets(manifest, [d.name for d in datasets if d.required])
    file_names = {r.dataset_name: r.txt_filename for r in manifest.select("dataset_name", "txt_filename").collect()}
    summaries = []
    for dataset in datasets:
        if dataset.name not in file_names:
            continue
        file_name, started = file_names[dataset.name], time.monotonic()
        try:
            raw = read_delimited(spark, f"{run_folder}/{file_name}", delimiter, encoding)
            staged = stage_rows(
                raw, dataset, run_id, file_name, ingested_at, on_too_many_fields=on_too_many_fields
            )
            replace_run(staged.accepted, f"{warehouse}/staging/{dataset.table}")
            replace_run(staged.rejected.drop(*FILE_ORDER), f"{warehouse}/quarantine/{dataset.table}")
            summary = staged.statistics.first().asDict() | {"error": None}
        except Exception as error:
            if dataset.required:
                raise
            summary = {
                "run_id": run_id,
                "dataset_name": dataset.name,
                "stage_table": dataset.table,
                "source_file_name": file_name,
                "rows_read": None,
                "rows_loaded": None,
                "rows_rejected": None,
                "status": "FAILED",
                "error": str(error),
            }
        summaries.append(summary | {"duration_seconds": time.monotonic() - started})
    return summaries
