"""The entity-quarter panel: spine, event counts, label and lagged features.

Facts are folded into one union and dealt by mine and quarter, where they are
summed; a busy mine spreads over its quarters. What follows needs a single
exchange on ``mine_key``: every window is ordered by (year, quarter) within a
mine, and a mine has at most four rows per calendar year. Both exchanges have
as many partitions as the facts have rows for, so a task holds about the same
number of rows whatever the size of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodlens.functions.numbers import guarded_ratio
from periodlens.functions.period import next_period_key

# Exposure bases of the published rates.
INCIDENT_RATE_HOURS = 200000.0
VIOLATION_RATE_HOURS = 10000.0

# Fact rows of one task: its hash tables stay near 100 MB each.
ROWS_PER_TASK = 200_000

# Bits of an unscaled decimal that are summed apart from the bits above them.
_LOW_BITS = 20

LABEL = "had_incident_next_qtr"

MEASURES = ("avg_employees", "employee_hours", "production_volume")

FEATURES = (
    "feat_prior_incident_count",
    "feat_rolling_4q_incident_count",
    "feat_prior_lost_day_incident_count",
    "feat_incident_rate_per_200k_hours",
    "feat_prior_violation_count",
    "feat_rolling_4q_violation_count",
    "feat_ss_share",
    "feat_production_per_employee_hour",
    "feat_production_efficiency_qoq_delta",
    "feat_violation_burden_qoq_delta",
    "feat_deterioration_streak_count",
)

BASE_COLUMNS = (
    "mine_key",
    "period_key",
    "year",
    "quarter",
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
)

LABEL_COLUMNS = (
    *BASE_COLUMNS,
    "next_period_key",
    "next_quarter_exists_flag",
    "next_quarter_incident_count",
    LABEL,
)

FEATURE_COLUMNS = (
    "mine_key",
    "period_key",
    "year",
    "quarter",
    LABEL,
    "next_period_key",
    "next_quarter_exists_flag",
    "incident_count_current_qtr",
    "incident_count_prior_qtr",
    "violation_count_current_qtr",
    "violation_count_prior_qtr",
    "employee_hours",
    "production_volume",
    "lost_day_incident_count_current_qtr",
    "ss_violation_count_current_qtr",
    "incident_rate_per_200k_hours_current_qtr",
    "violation_rate_per_10k_hours_current_qtr",
    "production_per_employee_hour_current_qtr",
    "incident_rate_qoq_delta",
    "deterioration_flag_current_qtr",
    *FEATURES,
)


def _by_time() -> WindowSpec:
    return Window.partitionBy("mine_key").orderBy("year", "quarter")


def _to_date() -> WindowSpec:
    return _by_time().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _last_four() -> WindowSpec:
    """Four reported quarters, not four calendar quarters."""
    return _by_time().rowsBetween(-3, Window.currentRow)


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


def _sums(facts: DataFrame, names: Sequence[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Columns to add to the facts and to sum per key, and the sums of ``names`` made from theirs.

    A sum of decimals has more digits than a long holds, and Spark then adds
    objects. Decimals that fit a long are summed as two longs instead, high and
    low bits of their unscaled value, which come together once per key. Sums
    are exact and have the type that ``sum`` gives.
    """
    parts, joined = {}, {}
    for name in names:
        kind = facts.schema[name].dataType
        if not isinstance(kind, T.DecimalType) or kind.precision > 18 or kind.scale > 6:
            parts[f"_{name}"] = F.col(name)
            joined[name] = F.col(f"_{name}")
            continue
        unscaled = (F.col(name) * F.lit(10**kind.scale)).cast("long")
        parts[f"_{name}_high"] = F.shiftright(unscaled, _LOW_BITS)
        parts[f"_{name}_low"] = unscaled.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
        high, low = (F.col(f"_{name}_{part}").cast("decimal(20,0)") for part in ("high", "low"))
        whole = (high * F.lit(1 << _LOW_BITS) + low) * F.lit(Decimal(1).scaleb(-kind.scale))
        joined[name] = whole.cast(T.DecimalType(kind.precision + 10, kind.scale))
    return parts, joined


def _fold(
    facts: DataFrame, keys: Sequence[str], numbers: Mapping[str, Column], summed: Sequence[str], tasks: int
) -> DataFrame:
    """Aggregate ``numbers`` per key, the sums of ``summed`` and the greatest ``production_unit``.

    The greatest text needs a sort aggregate. Facts are therefore reduced by
    hash per key and unit, and the few units of a key are folded after that,
    in the same task.
    """
    parts, joined = _sums(facts, summed)
    numbers = {**numbers, **{name: F.sum(name) for name in parts}}
    dealt = facts.withColumns(parts).repartition(tasks, *keys)
    by_unit = dealt.groupBy(*keys, "production_unit").agg(*[value.alias(name) for name, value in numbers.items()])
    kinds = dict(by_unit.dtypes)
    folded = {
        name: (F.max(name) if name in ("year", "quarter") else F.sum(name)).cast(kinds[name]) for name in numbers
    }
    return by_unit.groupBy(*keys).agg(
        *[value.alias(name) for name, value in folded.items()], F.max("production_unit").alias("production_unit")
    ).select(
        *keys, *[name for name in numbers if name not in parts], *[v.alias(name) for name, v in joined.items()], "production_unit"
    )


def activity_spine(employment: DataFrame) -> DataFrame:
    """Employment and production summed over sub-units per mine and quarter."""
    keys = ("mine_key", "period_key", "year", "quarter")
    return _fold(employment, keys, {}, MEASURES, tasks_for(employment.count()))


def incident_counts(incidents: DataFrame) -> DataFrame:
    """Incidents, and those with lost days, per mine and quarter."""
    return incidents.groupBy("mine_key", F.col("incident_quarter").alias("period_key")).agg(
        F.count("*").alias("incident_count_current_qtr"),
        F.count_if(F.col("lost_days") > 0).alias("lost_day_incident_count_current_qtr"),
    )


def violation_counts(violations: DataFrame) -> DataFrame:
    """Violations, and the significant ones, per mine and quarter."""
    return violations.groupBy("mine_key", F.col("violation_quarter").alias("period_key")).agg(
        F.count("*").alias("violation_count_current_qtr"),
        F.count_if(F.col("significant_substantial")).alias("ss_violation_count_current_qtr"),
    )


def _counts_by_quarter(employment: DataFrame, incidents: DataFrame, violations: DataFrame, tasks: int) -> DataFrame:
    """Spine with event counts; events in quarters without activity drop out."""
    activity = employment.select(
        "mine_key",
        "period_key",
        "year",
        "quarter",
        "avg_employees",
        "employee_hours",
        "production_volume",
        "production_unit",
        F.lit(True).alias("is_activity"),
    )
    incident = incidents.select(
        "mine_key",
        F.col("incident_quarter").alias("period_key"),
        F.lit(True).alias("is_incident"),
        (F.col("lost_days") > 0).alias("is_lost_day"),
    )
    violation = violations.select(
        "mine_key",
        F.col("violation_quarter").alias("period_key"),
        F.lit(True).alias("is_violation"),
        F.col("significant_substantial").alias("is_significant"),
    )
    facts = activity.unionByName(incident, allowMissingColumns=True)
    facts = facts.unionByName(violation, allowMissingColumns=True)
    numbers = {
        "year": F.max("year"),
        "quarter": F.max("quarter"),
        "activity_rows": F.count("is_activity"),
        "incident_count_current_qtr": F.count("is_incident"),
        "violation_count_current_qtr": F.count("is_violation"),
        "lost_day_incident_count_current_qtr": F.count_if("is_lost_day"),
        "ss_violation_count_current_qtr": F.count_if("is_significant"),
    }
    folded = _fold(facts, ("mine_key", "period_key"), numbers, MEASURES, tasks)
    return folded.where("activity_rows > 0").drop("activity_rows")


def _previous(name: str) -> Column:
    """Value of the previous reported quarter; gaps are skipped."""
    return F.lag(name).over(_by_time())


def _add_rates(df: DataFrame) -> DataFrame:
    hours = F.col("employee_hours")
    return df.withColumns(
        {
            "incident_rate_per_200k_hours_current_qtr": guarded_ratio(
                F.col("incident_count_current_qtr") * INCIDENT_RATE_HOURS, hours
            ),
            "violation_rate_per_10k_hours_current_qtr": guarded_ratio(
                F.col("violation_count_current_qtr") * VIOLATION_RATE_HOURS, hours
            ),
            "production_per_employee_hour_current_qtr": guarded_ratio(F.col("production_volume"), hours),
        }
    )


def _add_label(df: DataFrame) -> DataFrame:
    """Outcome of the next calendar quarter, NULL when it is not reported.

    The calendar successor, if reported, is always the next row of the mine,
    so looking one row ahead replaces a self join.
    """
    exists = F.coalesce(F.col("_following_key") == F.col("next_period_key"), F.lit(False))
    next_count = F.when(exists, F.col("_following_count"))
    return df.withColumns(
        {
            "next_quarter_exists_flag": exists.cast("int"),
            "next_quarter_incident_count": next_count,
            LABEL: F.when(exists, (next_count >= 1).cast("int")),
        }
    )


def _add_streak(df: DataFrame) -> DataFrame:
    """Quarters of deterioration in a row; NULL flags neither extend nor reset.

    Deteriorations so far, less those counted when the last reset happened.
    """
    flag = F.col("deterioration_flag_current_qtr")
    so_far = df.withColumn("_worse_so_far", F.count_if(flag == 1).over(_to_date()))
    at_reset = F.max(F.when(flag == 0, F.col("_worse_so_far"))).over(_to_date())
    marked = so_far.withColumn("_worse_at_reset", F.coalesce(at_reset, F.lit(0)))
    streak = F.when(flag == 1, F.col("_worse_so_far") - F.col("_worse_at_reset")).when(flag == 0, F.lit(0))
    return marked.withColumn("feat_deterioration_streak_count", streak.cast("long"))


def fact_rows(*facts: DataFrame) -> int:
    """Rows of all facts, counted in one job."""
    return reduce(DataFrame.union, [fact.select(F.lit(1)) for fact in facts]).count()


def build_panel(
    employment: DataFrame, incidents: DataFrame, violations: DataFrame, rows: int | None = None
) -> DataFrame:
    """All panel columns; select a view with the functions below.

    Unused columns, their windows included, are pruned by the optimizer.
    ``rows`` is the number of facts or an upper bound of it, and only decides
    how many tasks share the work; without it the facts are counted.
    """
    tasks = tasks_for(fact_rows(employment, incidents, violations) if rows is None else rows)
    quarters = _counts_by_quarter(employment, incidents, violations, tasks)
    counted = _add_rates(quarters.repartition(tasks, "mine_key"))
    incident_rate = "incident_rate_per_200k_hours_current_qtr"
    violation_rate = "violation_rate_per_10k_hours_current_qtr"
    efficiency = "production_per_employee_hour_current_qtr"
    looked_around = counted.withColumns(
        {
            "incident_count_prior_qtr": _previous("incident_count_current_qtr"),
            "violation_count_prior_qtr": _previous("violation_count_current_qtr"),
            "feat_prior_lost_day_incident_count": _previous("lost_day_incident_count_current_qtr"),
            "feat_rolling_4q_incident_count": F.sum("incident_count_current_qtr").over(_last_four()),
            "feat_rolling_4q_violation_count": F.sum("violation_count_current_qtr").over(_last_four()),
            "incident_rate_per_200k_hours_prior_qtr": _previous(incident_rate),
            "violation_rate_per_10k_hours_prior_qtr": _previous(violation_rate),
            "production_per_employee_hour_prior_qtr": _previous(efficiency),
            "next_period_key": next_period_key(F.col("year"), F.col("quarter")),
            "_following_key": F.lead("period_key").over(_by_time()),
            "_following_count": F.lead("incident_count_current_qtr").over(_by_time()),
        }
    )
    changed = _add_label(looked_around).withColumns(
        {
            "incident_rate_qoq_delta": F.col(incident_rate) - F.col("incident_rate_per_200k_hours_prior_qtr"),
            "violation_rate_qoq_delta": F.col(violation_rate) - F.col("violation_rate_per_10k_hours_prior_qtr"),
            "production_efficiency_qoq_delta": F.col(efficiency)
            - F.col("production_per_employee_hour_prior_qtr"),
        }
    )
    worse = [
        F.col("incident_rate_qoq_delta") > 0,
        F.col("violation_rate_qoq_delta") > 0,
        F.col("production_efficiency_qoq_delta") < 0,
    ]
    # greatest skips NULLs and is NULL only when all three changes are unknown.
    changed = changed.withColumn(
        "deterioration_flag_current_qtr", F.greatest(*[change.cast("int") for change in worse])
    )
    return _add_streak(changed).withColumns(
        {
            "assessed_penalty_amount_current_qtr": F.lit(0).cast("long"),
            "assessed_penalty_amount_prior_qtr": F.lit(None).cast("long"),
            "feat_prior_incident_count": F.col("incident_count_prior_qtr"),
            "feat_prior_violation_count": F.col("violation_count_prior_qtr"),
            "feat_incident_rate_per_200k_hours": F.col(incident_rate),
            "feat_production_per_employee_hour": F.col(efficiency),
            "feat_production_efficiency_qoq_delta": F.col("production_efficiency_qoq_delta"),
            "feat_violation_burden_qoq_delta": F.col("violation_rate_qoq_delta"),
            "feat_ss_share": guarded_ratio(
                F.col("ss_violation_count_current_qtr"), F.col("violation_count_current_qtr")
            ),
        }
    ).drop("_following_key", "_following_count", "_worse_so_far", "_worse_at_reset")


def base_view(panel: DataFrame) -> DataFrame:
    return panel.select(*BASE_COLUMNS)


def label_view(panel: DataFrame) -> DataFrame:
    return panel.select(*LABEL_COLUMNS)


def feature_view(panel: DataFrame) -> DataFrame:
    return panel.select(*FEATURE_COLUMNS)


def training_view(panel: DataFrame) -> DataFrame:
    """Feature rows whose next quarter is known."""
    return feature_view(panel).where(F.col(LABEL).isNotNull())


def time_split(training: DataFrame, validation_year: int) -> tuple[DataFrame, DataFrame]:
    """All years before the validation year, and that year."""
    return (
        training.where(F.col("year") < validation_year),
        training.where(F.col("year") == validation_year),
    )
