import numpy as np
import pytest

from periodlens.operators import metrics
from periodlens.plans import reports

SCHEMA = (
    "model_version string, year int, mine_key long, period_key string, risk_score double, label_next_period int"
)


def scored(spark, splits):
    rows = []
    for (version, year), pairs in splits.items():
        rows += [(version, year, i, f"{year}Q1", s, label) for i, (s, label) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(pairs):
    """ROC-AUC and average precision from all pairs and thresholds."""
    positives = [s for s, label in pairs if label == 1]
    negatives = [s for s, label in pairs if label == 0]
    if not positives or not negatives:
        return None, None
    won = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    precision = recall = average = 0.0
    for threshold in sorted({s for s, _ in pairs}, reverse=True):
        inside = [label for s, label in pairs if s >= threshold]
        precision, previous = sum(inside) / len(inside), recall
        recall = sum(inside) / len(positives)
        average += (recall - previous) * precision
    return won / (len(positives) * len(negatives)), average


@pytest.fixture(scope="module")
def splits():
    random = np.random.default_rng(2)
    tied = [(float(s), int(random.random() < s)) for s in random.choice([0.1, 0.2, 0.2, 0.7], 300)]
    return {
        ("small", 2020): [(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 0), (0.4, 0), (0.3, 1)],
        ("tied", 2020): tied,
        ("smooth", 2021): [(s, int(random.random() < s)) for s in random.random(200).tolist()],
        ("no positives", 2020): [(0.4, 0), (0.5, 0)],
        ("no negatives", 2021): [(0.4, 1), (0.5, 1)],
    }


def test_ranking_quality(spark, splits):
    found = {(r.model_version, r.year): (r.roc_auc, r.pr_auc) for r in metrics.ranking_quality(scored(spark, splits)).collect()}
    assert found["small", 2020] == pytest.approx((0.5, 2 / 3))
    for key, pairs in splits.items():
        wanted = brute_force(pairs)
        assert found[key] == (wanted if wanted[0] is None else pytest.approx(wanted))


def test_top_fraction(spark, splits):
    found = {(r.model_version, r.year): r for r in metrics.top_fraction_metrics(scored(spark, splits)).collect()}
    small = found["small", 2020]
    assert (small.top_decile_size, small.top_decile_positive_count) == (1, 1)
    assert (small.precision_at_top_decile, small.recall_at_top_decile) == pytest.approx((1, 1 / 3))
    assert (small.base_rate, small.lift_vs_base_rate) == pytest.approx((0.5, 2))
    none = found["no positives", 2020]
    assert (none.recall_at_top_decile, none.lift_vs_base_rate) == (None, None)
    for key, pairs in splits.items():
        ordered = sorted(enumerate(pairs), key=lambda p: (-p[1][0], p[0]))
        size = max(1, int(np.ceil(0.1 * len(pairs))))
        assert found[key].top_decile_size == size
        assert found[key].top_decile_positive_count == sum(label for _, (_, label) in ordered[:size])


def summary_input(spark):
    columns = (
        "model_name string, model_version string, validation_year int, train_start_year int, train_end_year int, "
        "n_train_rows int, n_validation_rows int, n_validation_positives int, base_rate double, "
        "top_decile_size int, top_decile_positive_count int, roc_auc double, pr_auc double, "
        "precision_at_top_decile double, recall_at_top_decile double, lift_vs_base_rate double"
    )
    return spark.createDataFrame(
        [
            ("logreg", "l1", 2020, 2000, 2019, 100, 100, 20, 0.2, 10, 8, 0.8, None, 0.8, 0.4, 4.0),
            ("logreg", "l2", 2021, 2000, 2020, 200, 300, 20, 0.0667, 30, 12, 0.6, 0.5, 0.4, 0.6, 6.0),
            ("rule_score", "r1", 2020, 2000, 2019, 100, 50, 0, 0.0, 5, 0, None, None, 0.0, None, None),
        ],
        columns,
    )


def test_summary_and_claims(spark):
    results = summary_input(spark)
    rows = {r.model_name: r for r in metrics.model_summary(results).collect()}
    logreg, rule = rows["logreg"], rows["rule_score"]
    assert (logreg.n_splits, logreg.macro_roc_auc, logreg.macro_pr_auc) == (2, pytest.approx(0.7), 0.5)
    assert logreg.pooled_base_rate == pytest.approx(0.1)
    assert logreg.pooled_precision_at_top_decile == pytest.approx(0.5)
    assert logreg.pooled_lift_vs_base_rate == pytest.approx(5.0)
    assert (rule.macro_roc_auc, rule.pooled_recall_at_top_decile, rule.pooled_lift_vs_base_rate) == (None, None, None)
    texts = [r.claim for r in reports.claims(metrics.model_summary(results)).collect()]
    assert texts == [
        "logreg: top 10% highest-risk mines captured 50.0% of next-quarter incidents at 5.00x the base rate.",
        "rule_score: capture rate at top decile could not be computed.",
    ]


def test_backtest_view(spark):
    view = reports.backtest_summary(summary_input(spark))
    rows = {r.model_version: r for r in view.collect()}
    assert rows["l1"].model_validation_key == "l1|2020"
    assert rows["l1"].n_splits_for_model == 2
    assert rows["r1"].business_claim_text == "rule_score: pooled capture rate could not be computed."
    pooled = reports.pooled_metrics(view).collect()
    assert len(pooled) == 1 and pooled[0].pooled_recall_at_top_decile == pytest.approx(0.5)
    assert reports.yearly_metrics(view.unionByName(view)).count() == 3
    assert [r.model_version for r in reports.backtest_listing(view).collect()] == ["l1", "l2", "r1"]
