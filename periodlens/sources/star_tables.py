"""Panel facts drawn from the part / lineitem test tables.

Part stands in for the mine. Finished lines are activity, open returned lines
are incidents and the other open lines violations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Facts:
    mines: DataFrame
    employment: DataFrame
    incidents: DataFrame
    violations: DataFrame


# SQL text keeps the driver's plan building short.
_PERIOD = "concat(year(l_shipdate), 'Q', quarter(l_shipdate))"
# As line ids hold them, so that each is cast from double once for both.
_QUANTITY, _PRICE = "cast(l_quantity AS decimal(18,2))", "cast(l_extendedprice AS decimal(18,2))"
_LINE_ID = """sha2(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
    cast(cast(l_shipdate AS date) AS string), cast(l_quantity AS decimal(18,2)),
    cast(l_extendedprice AS decimal(18,2)), cast(l_discount AS decimal(18,2)), cast(l_tax AS decimal(18,2))), 256)"""


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/lineitem.parquet")


def load_facts(spark: SparkSession, folder: str) -> Facts:
    """The four tables of the warehouse, in their stored types."""
    lines = _lines(spark, folder)
    employment = lines.where("l_linestatus = 'F'").selectExpr(
        "l_partkey AS mine_key",
        "year(l_shipdate) AS year",
        "quarter(l_shipdate) AS quarter",
        f"{_PERIOD} AS period_key",
        "cast(l_linenumber AS decimal(12,2)) AS avg_employees",
        f"cast({_QUANTITY} AS decimal(14,2)) AS employee_hours",
        f"cast({_PRICE} AS decimal(16,2)) AS production_volume",
        "l_returnflag AS production_unit",
        f"{_LINE_ID} AS source_record_id",
        "cast(l_shipdate AS timestamp) AS load_ts",
    )
    incidents = lines.where("l_linestatus = 'O' AND l_returnflag = 'R'").selectExpr(
        "l_partkey AS mine_key",
        "cast(l_shipdate AS date) AS incident_date",
        f"{_PERIOD} AS incident_quarter",
        "'returned' AS incident_type",
        "cast(l_linenumber AS string) AS severity_class",
        "greatest(l_linenumber - 3, 0) AS lost_days",
        "0 AS days_restricted",
        f"cast({_QUANTITY} AS decimal(14,2)) AS hours_worked_basis",
        f"{_LINE_ID} AS source_record_id",
        "cast(l_shipdate AS timestamp) AS load_ts",
    )
    violations = lines.where("l_linestatus = 'O' AND l_returnflag <> 'R'").selectExpr(
        "l_partkey AS mine_key",
        "cast(l_orderkey AS string) AS inspection_event_no",
        "cast(l_shipdate AS date) AS violation_date",
        f"{_PERIOD} AS violation_quarter",
        "cast(l_linenumber AS string) AS section_code",
        "cast(NULL AS string) AS likelihood_code",
        "cast(NULL AS string) AS negligence_code",
        "l_discount > 0.05D AS significant_substantial",
        "l_returnflag AS citation_order_flag",
        f"{_LINE_ID} AS source_record_id",
        "cast(l_shipdate AS timestamp) AS load_ts",
    )
    return Facts(load_mines(spark, folder), employment, incidents, violations)


def load_mines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/part.parquet").selectExpr(
        "p_partkey AS mine_key",
        "cast(p_partkey AS string) AS mine_id",
        "'MSHA' AS source_system",
        "p_name AS mine_name",
        "'US' AS country_code",
        "p_brand AS province_state",
        "p_type AS commodity_group",
        "cast(p_size AS string) AS mine_type",
        "cast(NULL AS decimal(10,6)) AS latitude",
        "cast(NULL AS decimal(10,6)) AS longitude",
        "true AS active_flag",
        "timestamp '2001-01-01 00:00:00' AS created_at",
        "timestamp '2001-01-01 00:00:00' AS updated_at",
    )


def load_assessed(spark: SparkSession, folder: str) -> DataFrame:
    """Assessed violations: open, unreturned lines with a high discount."""
    open_lines = _lines(spark, folder).where("l_linestatus = 'O' AND l_returnflag <> 'R'")
    return open_lines.where("l_discount > 0.05D").selectExpr(
        "l_partkey AS mine_key",
        "cast(l_shipdate AS date) AS assessed_date",
        f"{_PERIOD} AS assessed_quarter",
        "cast(l_extendedprice AS decimal(14,2)) AS proposed_penalty_amount",
        "if(l_returnflag = 'N', cast(l_quantity AS decimal(14,2)), NULL) AS assessment_amount",
        "cast(l_orderkey AS string) AS violation_reference_raw",
        f"{_LINE_ID} AS source_record_id",
    )


def load_staged(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The same rows in the shape of the staging tables, one run each."""
    facts = load_facts(spark, folder)
    key = F.col("mine_key").cast("string").alias("mine_id")
    return {
        "mine": facts.mines.drop("mine_key"),
        "employment": facts.employment.select("*", key)
        .drop("mine_key")
        .withColumnRenamed("production_unit", "production_unit_raw"),
        "incident": facts.incidents.select("*", key).drop("mine_key").withColumnsRenamed(
            {"incident_type": "incident_type_raw", "severity_class": "severity_class_raw"}
        ),
        "violation": facts.violations.select("*", key)
        .drop("mine_key")
        .withColumnRenamed("inspection_event_no", "event_number"),
        "assessed_violation": load_assessed(spark, folder).select("*", key).drop("mine_key"),
    }


def _hundredths(name: str) -> F.Column:
    return F.round(F.col(name) * 100).cast("long")


def _money(name: str) -> F.Column:
    return F.col(name).cast("decimal(16,2)").cast("string")


def raw_texts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Untidy text rows for the five raw files, bad rows included."""
    parts = spark.read.parquet(f"{folder}/part.parquet")
    lines = _lines(spark, folder)
    shipped = F.col("l_shipdate").cast("date")
    number = F.col("l_linenumber")
    mixed_date = (
        F.when(number == 2, F.date_format(shipped, "M/d/yyyy"))
        .when(number == 3, F.date_format(shipped, "yyyyMMdd"))
        .when(number == 4, F.upper(F.date_format(shipped, "dd-MMM-yyyy")))
        .when(number == 5, F.date_format(shipped, "yyyy/MM/dd"))
        .when(number == 7, F.lit("13/45/2000"))
        .otherwise(F.date_format(shipped, "yyyy-MM-dd"))
    )
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey")
    still_open = F.col("l_linestatus") == "O"
    returned = F.col("l_returnflag") == "R"
    size = F.col("p_size").cast("string")
    return {
        "msha_mines": parts.select(
            F.col("p_partkey").alias("Mine ID"),
            F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("MINE_NAME"),
            F.when(F.col("p_size") > 25, "Active").otherwise(" ").alias("Current Status"),
            F.col("p_brand").alias("STATE"),
            F.concat(F.lit("|"), "p_type").alias("Primary Commodity"),
            size.alias("mine-type-cd"),
            F.when(F.col("p_size") == 13, "unknown").otherwise(size).alias("LATITUDE"),
            F.concat(F.lit("-"), size, F.lit(".5")).alias("LONGITUDE"),
        ),
        "msha_employment_production_quarterly": lines.where(F.col("l_linestatus") == "F").select(
            F.col("l_partkey").alias("MINE_ID"),
            F.year(shipped).alias("CAL_YR"),
            F.when(_hundredths("l_tax") == 8, F.lit(5)).otherwise(F.quarter(shipped)).alias("CAL_QTR"),
            line.alias("SUBUNIT_CD"),
            F.when(number != 7, number).alias("AVG_EMPLOYEES"),
            F.format_number(F.col("l_quantity") * 1000, 2).alias("Employee Hours"),
            F.when(_hundredths("l_discount") == 0, "0.00").otherwise(_money("l_extendedprice")).alias("PRODUCTION"),
            F.col("l_returnflag").alias("PROD_UNIT"),
        ),
        "msha_incidents": lines.where(still_open & returned).select(
            F.expr(_LINE_ID).alias("DOCUMENT_NO"),
            F.col("l_partkey").alias("MINE_ID"),
            mixed_date.alias("ACCIDENT_DT"),
            F.lit('slip "or" fall').alias("ACCIDENT_TYPE"),
            number.alias("DEGREE_INJURY"),
            F.when(_hundredths("l_tax") == 0, "2.0")
            .otherwise(F.greatest(number - 3, F.lit(0)).cast("string"))
            .alias("LOST_DAYS"),
            F.when(_hundredths("l_tax") == 1, "-1").otherwise("0").alias("DAYS_RESTRICTED"),
            _money("l_quantity").alias("HOURS_WORKED"),
        ),
        "msha_violations": lines.where(still_open & ~returned)
        .sort("l_shipdate", "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_tax")
        .select(
            F.col("l_partkey").alias("MINE_ID"),
            F.lit("").alias("EVENT_NO"),
            F.date_format(shipped, "yyyy-MM-dd").alias("VIOLATION_ISSUE_DT"),
            line.alias("LIKELIHOOD"),
            F.col("l_returnflag").alias("NEGLIGENCE"),
            F.when(_hundredths("l_discount") == 0, "maybe")
            .when(F.col("l_discount") > 0.05, "Y")
            .otherwise("no")
            .alias("S&S"),
            F.when(F.col("l_discount") > 0.05, " TRUE ").otherwise("0").alias("SIG_SUB"),
        ),
        "msha_assessed_violations": lines.where(still_open & ~returned & (F.col("l_discount") > 0.05)).select(
            F.col("l_partkey").alias("MINE_ID"),
            line.alias("CASE_NO"),
            F.date_format(shipped, "M/d/yyyy").alias("ISSUE_DT"),
            number.alias("SECTION"),
            _money("l_extendedprice").alias("PROPOSED_PENALTY"),
            F.when(F.col("l_returnflag") == "N", _money("l_quantity")).alias("ASSESSED_AMOUNT"),
            F.lit("Closed").alias("CASE_STATUS"),
            F.col("l_orderkey").alias("VIOLATION_ID"),
        ),
    }


def write_raw_file(spark: SparkSession, folder: str, dataset: str, target: str) -> None:
    """Write one raw file the way the source publishes it."""
    raw_texts(spark, folder)[dataset].write.option("sep", "|").option("header", True).option(
        "encoding", "ISO-8859-1"
    ).option("escape", '"').csv(target)
