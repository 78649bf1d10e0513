import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from periodlens.operators import checks, panel

def facts(spark, spine, incidents, violations):
    rows = [(k, p, int(p[:4]), int(p[5]), 1, h, v, "t") for k, p, h, v in spine]
    employment = spark.createDataFrame(
        pd.DataFrame(rows, columns=["mine_key", "period_key", "year", "quarter", "e", "h", "v", "u"]).astype(
            {"h": "float64"}
        ),
        "mine_key long, period_key string, year int, quarter int, e long, h double, v long, u string",
    ).select(
        "mine_key",
        "period_key",
        "year",
        "quarter",
        F.col("e").cast("decimal(12,2)").alias("avg_employees"),
        F.nanvl(F.col("h"), F.lit(None)).cast("decimal(14,2)").alias("employee_hours"),
        F.col("v").cast("decimal(16,2)").alias("production_volume"),
        F.col("u").alias("production_unit"),
    )
    return (
        employment,
        spark.createDataFrame(incidents, "mine_key long, incident_quarter string, lost_days int"),
        spark.createDataFrame(violations, "mine_key long, violation_quarter string, significant_substantial boolean"),
    )


SPINE = [
    (1, "2020Q1", 600, 60),
    (1, "2020Q1", 400, 40),
    (1, "2020Q2", 0, 50),
    (1, "2020Q4", 2000, 300),
    (1, "2021Q1", 2000, 200),
    (1, "2021Q2", 2000, 100),
    (1, "2021Q3", 2000, 400),
    (2, "2020Q4", None, 10),
    (2, "2021Q1", 1000, 10),
]
INCIDENTS = [(1, "2020Q2", 0), (1, "2020Q2", 5), (1, "2020Q3", 9), (1, "2021Q1", None), (2, "2021Q1", 1)]
VIOLATIONS = [
    (1, "2020Q1", True),
    (1, "2020Q1", None),
    (1, "2021Q2", True),
    (1, "2021Q2", False),
    (1, "2021Q2", True),
    (1, "2021Q2", False),
]
GOLDEN_COLUMNS = [
    "mine_key",
    "period_key",
    "incident_count_current_qtr",
    "violation_count_current_qtr",
    "had_incident_next_qtr",
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
    "deterioration_flag_current_qtr",
    "feat_deterioration_streak_count",
]
N = None
GOLDEN = [
    (1, "2020Q1", 0, 2, 1, N, 0, N, 0, N, 2, 0.5, 0.1, N, N, N, N),
    (1, "2020Q2", 2, 0, N, 0, 2, 0, N, 2, 2, N, N, N, N, N, N),
    (1, "2020Q4", 0, 0, 1, 2, 2, 1, 0, 0, 2, N, 0.15, N, N, N, N),
    (1, "2021Q1", 1, 0, 0, 0, 3, 0, 100, 0, 2, N, 0.1, -0.05, 0, 1, 1),
    (1, "2021Q2", 0, 4, 0, 1, 3, 0, 0, 0, 4, 0.5, 0.05, -0.05, 20, 1, 2),
    (1, "2021Q3", 0, 0, N, 0, 1, 0, 0, 4, 4, N, 0.2, 0.15, -20, 0, 0),
    (2, "2020Q4", 0, 0, 1, N, 0, N, N, N, 0, N, N, N, N, N, N),
    (2, "2021Q1", 1, 0, N, 0, 1, 0, 200, 0, 0, N, 0.01, N, N, N, N),
]


@pytest.fixture(scope="module")
def golden(spark):
    return panel.build_panel(*facts(spark, SPINE, INCIDENTS, VIOLATIONS)).cache()


def test_golden_panel(golden):
    found = panel.feature_view(golden).select(*GOLDEN_COLUMNS).orderBy("mine_key", "period_key").collect()
    assert len(found) == len(GOLDEN)
    for row, wanted in zip(found, GOLDEN):
        assert [None if v is None else v for v in row] == [
            w if w is None or isinstance(w, str) else pytest.approx(w) for w in wanted
        ]


def test_views_have_contract_columns(golden):
    assert len(panel.base_view(golden).columns) == 14
    assert len(panel.label_view(golden).columns) == 18
    assert len(panel.feature_view(golden).columns) == 31


def test_checks_pass_on_golden(golden):
    base, labels, features = panel.base_view(golden), panel.label_view(golden), panel.feature_view(golden)
    assert checks.raise_on_failures(checks.base_checks(base), "base") == {"row_count": 8}
    assert checks.raise_on_failures(checks.label_checks(labels, base), "labels") == {
        "label_null_count": 3,
        "label_zero_count": 2,
        "label_one_count": 3,
    }
    found = checks.raise_on_failures(
        checks.feature_checks(features, labels, panel.training_view(golden)), "features"
    )
    assert found == {"feature_row_count": 8, "training_row_count": 5}


def test_checks_find_faults(golden):
    base = panel.base_view(golden)
    broken = base.unionByName(base.where("mine_key = 2")).withColumn(
        "quarter", F.when(F.col("period_key") == "2021Q3", 7).otherwise(F.col("quarter"))
    )
    counts = {r.test_name: r.failure_count for r in checks.base_checks(broken).collect()}
    assert counts["duplicate_grain"] == 2
    assert counts["invalid_quarter"] == 1
    assert counts["period_mismatch"] == 1
    with pytest.raises(ValueError, match="duplicate_grain"):
        checks.raise_on_failures(checks.base_checks(broken), "base")


@pytest.fixture(scope="module")
def busy(spark):
    """One mine with most of the raw rows, gaps between quarters."""
    random = np.random.default_rng(5)
    periods = [f"{y}Q{q}" for y in range(2000, 2015) for q in range(1, 5)]
    spine, incidents, violations = [], [], []
    for mine in range(20):
        for key in periods:
            if random.random() < 0.3:
                continue
            hours = random.choice([None, 0, 100, 200, 400], p=[0.1, 0.1, 0.3, 0.3, 0.2])
            copies = 40 if mine == 0 else 1
            spine += [(mine, key, hours, int(random.integers(0, 50)))] * copies
            incidents += [(mine, key, int(random.integers(0, 3)))] * int(random.integers(0, 3))
            violations += [(mine, key, bool(random.random() < 0.5))] * int(random.integers(0, 4))
    return panel.build_panel(*facts(spark, spine, incidents, violations)).cache()


def test_label_equals_self_join(busy):
    labels = panel.label_view(busy)
    following = labels.select(
        F.col("mine_key").alias("k"),
        F.col("period_key").alias("p"),
        F.col("incident_count_current_qtr").alias("c"),
    )
    joined = labels.join(
        following, (F.col("mine_key") == F.col("k")) & (F.col("next_period_key") == F.col("p")), "left"
    )
    wanted = F.when(F.col("c").isNotNull(), (F.col("c") >= 1).cast("int"))
    assert joined.where(~wanted.eqNullSafe(F.col(panel.LABEL))).count() == 0
    assert joined.where(~F.col("c").eqNullSafe(F.col("next_quarter_incident_count"))).count() == 0


def test_streak_equals_loop(busy):
    rows = busy.select("mine_key", "year", "quarter", "deterioration_flag_current_qtr", "feat_deterioration_streak_count")
    last, streak = None, 0
    for row in sorted(rows.collect()):
        if row.mine_key != last:
            last, streak = row.mine_key, 0
        flag = row.deterioration_flag_current_qtr
        streak = 0 if flag == 0 else streak + (flag or 0)
        assert row.feat_deterioration_streak_count == (None if flag is None else streak)


def test_time_split(busy):
    train, valid = panel.time_split(panel.training_view(busy), 2010)
    assert train.agg(F.max("year")).first()[0] == 2009
    assert [r.year for r in valid.select("year").distinct().collect()] == [2010]


def test_facts_are_reduced_by_hash(spark):
    from periodlens.operators import panel

    employment = spark.range(4).selectExpr(
        "id AS mine_key", "'2020Q1' AS period_key", "2020 AS year", "1 AS quarter", "1.5 AS avg_employees",
        "2.5 AS employee_hours", "3.5 AS production_volume", "cast(id % 2 AS string) AS production_unit",
    )
    plan = panel.activity_spine(employment)._jdf.queryExecution().executedPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest and "production_unit" in lowest.split("functions=")[0]


def test_tasks_grow_with_the_facts(spark, monkeypatch):
    monkeypatch.setattr(panel, "ROWS_PER_TASK", 50)

    def partitions(mines):
        quarters = [f"{2010 + i // 4}Q{i % 4 + 1}" for i in range(8)]
        spine = [(mine, quarter, 100, 10) for mine in range(mines) for quarter in quarters]
        given = facts(spark, spine, [(mine, "2010Q1", 0) for mine in range(mines)], VIOLATIONS)
        whole = panel.feature_view(panel.build_panel(*given))
        plan = whole._jdf.queryExecution().executedPlan().toString()
        assert whole.count() == 8 * mines
        return [line.split(", ")[-3:] for line in plan.splitlines() if "REPARTITION_BY_NUM" in line], whole.rdd.getNumPartitions()

    dealt, few = partitions(10)
    assert len(dealt) == 2 and few == 2  # 96 facts
    assert partitions(100)[1] == 19  # 906 facts


def test_decimals_are_summed_as_longs(spark):
    from decimal import Decimal

    given = [("7.25", "999999999999.99", "99999999999999.99"), ("-0.01", "-0.02", None), (None, "999999999999.99", "99999999999999.99")]
    rows = [(1, "2020Q1", 2020, 1, *[x and Decimal(x) for x in measures], unit) for measures, unit in zip(given, "aab")]
    employment = spark.createDataFrame(
        [*rows, (2, "2020Q1", 2020, 1, None, None, None, None)],
        "mine_key long, period_key string, year int, quarter int, avg_employees decimal(12,2), "
        "employee_hours decimal(14,2), production_volume decimal(16,2), production_unit string",
    )
    spine = panel.activity_spine(employment)
    assert [kind for _, kind in spine.dtypes[4:7]] == ["decimal(22,2)", "decimal(24,2)", "decimal(26,2)"]
    first, second = spine.sort("mine_key").collect()
    assert first[4:] == (Decimal("7.24"), Decimal("1999999999999.96"), Decimal("199999999999999.98"), "b")
    assert second[4:] == (None, None, None, None)
    assert "sum(employee_hours" not in spine._jdf.queryExecution().executedPlan().toString()
