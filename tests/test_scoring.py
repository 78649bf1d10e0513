import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from periodlens.operators import checks, panel, scoring
from periodlens.operators.panel import FEATURES, LABEL


@pytest.fixture(scope="module")
def training(spark):
    random = np.random.default_rng(11)
    rows = 1200
    data = {
        "mine_key": np.arange(rows) // 8,
        "year": 2018 + (np.arange(rows) % 8) // 2,
        "quarter": 1 + (np.arange(rows) % 2),
    }
    for i, feature in enumerate(FEATURES):
        values = random.normal(i, 1 + i, rows).round(2)
        if i % 2 == 0:
            values = np.maximum(values, 0).round(0)
        values[random.random(rows) < 0.1] = np.nan
        data[feature] = values
    pdf = pd.DataFrame(data)
    pdf["feat_ss_share"] = 0.0
    risk = pdf[FEATURES[0]].fillna(0) - 0.3 * pdf[FEATURES[3]].fillna(0)
    pdf[LABEL] = (random.random(rows) < 1 / (1 + np.exp(-(risk - risk.mean())))).astype(int)
    pdf["period_key"] = pdf.year.astype(str) + "Q" + pdf.quarter.astype(str)
    df = spark.createDataFrame(pdf).withColumns(
        {f: F.nanvl(F.col(f), F.lit(None)) for f in FEATURES}
    ).withColumns({"year": F.col("year").cast("int"), LABEL: F.col(LABEL).cast("int")})
    return df.cache(), pdf


def test_split_stats(training):
    df, pdf = training
    stats = scoring.split_stats(df, [2020, 2021])
    train = pdf[pdf.year < 2020]
    assert stats[2020].train_rows == len(train)
    assert stats[2020].train_positives == train[LABEL].sum()
    assert (stats[2020].first_train_year, stats[2020].last_train_year) == (2018, 2019)
    assert stats[2021].valid_rows == (pdf.year == 2021).sum()


def test_rule_bounds_match_pandas(training):
    df, pdf = training
    found = {(r.validation_year, r["name"]): (r.p05, r.p95) for r in scoring.rule_bounds(df, [2020, 2021]).collect()}
    for year in (2020, 2021):
        for feature in scoring.RULE_WEIGHTS:
            values = pdf[pdf.year < year][feature].fillna(0)
            assert found[year, feature] == pytest.approx((values.quantile(0.05), values.quantile(0.95)), abs=1e-9)


def test_rule_scores_match_pandas(training):
    df, pdf = training
    scored = scoring.score_rule(df, [2020, 2021])
    found = scored.rows.toPandas().set_index(["mine_key", "period_key"])
    assert len(found) == pdf.year.isin([2020, 2021]).sum()
    for year in (2020, 2021):
        valid = pdf[pdf.year == year]
        parts = {}
        for feature, weight in scoring.RULE_WEIGHTS.items():
            bounds = scored.fitted[year]["normalization_bounds"][feature]
            low, high = bounds["p05"], bounds["p95"]
            share = valid[feature].fillna(0).clip(low, high) * 0
            if high != low:
                share = (valid[feature].fillna(0).clip(low, high) - low) / (high - low)
            parts[feature] = weight * (1 - share if feature in scoring.NEGATIVE_DIRECTION else share)
        parts = pd.DataFrame(parts)
        for i in valid.index:
            row = found.loc[(valid.mine_key[i], valid.period_key[i])]
            assert row.risk_score == pytest.approx(parts.loc[i].sum())
            ordered = parts.loc[i].sort_values(ascending=False, kind="stable").index[:3]
            assert [row.top_driver_1, row.top_driver_2, row.top_driver_3] == [
                scoring.RULE_DRIVERS[f] for f in ordered
            ]
            assert row.model_version == f"rule_score_v1_train_to_{year - 1}_validate_{year}"


def newton(x, y, c=1.0):
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    penalty = np.eye(x.shape[1])
    penalty[-1, -1] = 0
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = c * x.T @ (weight * (p - y)) + penalty @ beta
        hessian = c * (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_logistic_matches_newton(training):
    df, pdf = training
    scored = scoring.score_logistic(df, [2021])
    train, valid = pdf[pdf.year < 2021], pdf[pdf.year == 2021]
    mean, scale = train[list(FEATURES)].fillna(0).mean(), train[list(FEATURES)].fillna(0).std(ddof=0)
    scale = scale.replace(0, 1.0)
    beta = newton(((train[list(FEATURES)].fillna(0) - mean) / scale).to_numpy(), train[LABEL].to_numpy(float))
    fitted = scored.fitted[2021]
    assert fitted["scaler_scale"] == pytest.approx(scale.tolist())
    assert [*fitted["coefficients"], fitted["intercept"]] == pytest.approx(beta, abs=1e-5)
    scaled = (valid[list(FEATURES)].fillna(0) - mean) / scale
    wanted = 1 / (1 + np.exp(-(scaled.to_numpy() @ beta[:-1] + beta[-1])))
    found = scored.rows.toPandas().set_index(["mine_key", "period_key"]).risk_score
    keys = list(zip(valid.mine_key, valid.period_key))
    assert found.loc[keys].to_numpy() == pytest.approx(wanted, abs=1e-5)


def test_years_are_fitted_together(training):
    df, pdf = training
    both = scoring.score_logistic(df, [2020, 2021]).fitted
    for year in (2020, 2021):
        alone = scoring.score_logistic(df, [year]).fitted[year]
        assert both[year]["coefficients"] == pytest.approx(alone["coefficients"], abs=1e-9)
    with pytest.raises(RuntimeError, match="no fit within 1 steps for .2020, 2021."):
        scoring.score_logistic(df, [2020, 2021], max_iter=1)


def test_fit_of_constant_equal_and_separating_features(training):
    df, _ = training
    first, second, third, *_ = FEATURES
    odd = df.withColumns(
        {first: F.lit(3.0), third: F.col(second), FEATURES[4]: F.col(LABEL) * 1000.0, FEATURES[5]: F.lit(None).cast("double")}
    )
    fitted = scoring.score_logistic(odd, [2021])
    beta = dict(zip(FEATURES, fitted.fitted[2021]["coefficients"]))
    assert [beta[first], beta[FEATURES[5]]] == pytest.approx([0.0, 0.0], abs=1e-12)
    assert beta[second] == pytest.approx(beta[third], abs=1e-6) and beta[FEATURES[4]] > 1
    assert scoring.logistic_gradients(odd, fitted).first().largest_gradient < 1e-8


def test_drivers(spark):
    values = {"a": 0.5, "b": -0.9, "c": 0.0, "d": 0.5, "e": -0.1}
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()])
    parts = {n: F.col(n) for n in values}
    first = row.select(*scoring.top_drivers(parts, {"a": "text of a"}, True)).first()
    plain = row.select(*scoring.top_drivers(parts, {}, False)).first()
    assert tuple(first) == ("text of a", "d", "b")
    assert tuple(plain) == ("a", "d", "c")
    short = row.select(*scoring.top_drivers({"a": F.col("a")}, {}, False)).first()
    assert tuple(short) == ("a", None, None)


def test_bands(spark):
    df = spark.createDataFrame([(0.24999,), (0.25,), (0.5,), (0.75,)], "s double")
    found = [r[0] for r in df.select(scoring.risk_band(F.col("s"))).collect()]
    assert found == ["Low", "Medium", "High", "Critical"]


def test_missing_feature_is_named(training):
    df, _ = training
    weights = {**scoring.RULE_WEIGHTS, scoring.PENALTY_FEATURE: scoring.PENALTY_WEIGHT}
    with pytest.raises(ValueError, match="assessed_penalty"):
        scoring.score_rule(df, [2021], weights)


def test_unusable_splits(training):
    df, _ = training
    with pytest.raises(ValueError, match="empty"):
        scoring.score_rule(df, [2018])
    with pytest.raises(scoring.SingleClassError):
        scoring.score_rule(df.withColumn(LABEL, F.lit(0)), [2021])


def test_metadata(training):
    df, pdf = training
    metadata = scoring.model_metadata(scoring.score_rule(df, [2021]), 2021)
    assert metadata["row_count_train"] == (pdf.year < 2021).sum()
    assert metadata["positive_rate_validation"] == pytest.approx(pdf[pdf.year == 2021][LABEL].mean())
    assert metadata["risk_band_thresholds"] == {"low": 0.25, "medium": 0.5, "high": 0.75}


def test_score_checks(training):
    df, pdf = training
    rows = scoring.score_rule(df, [2021]).rows
    good = checks.raise_on_failures(checks.score_checks(rows), "scores")
    assert good["row_count"] == (pdf.year == 2021).sum()
    broken = rows.withColumn("risk_score", F.when(F.col("mine_key") == 0, 2.0).otherwise(F.col("risk_score")))
    with pytest.raises(ValueError, match="score_out_of_range"):
        checks.raise_on_failures(checks.score_checks(broken), "scores")
    version = scoring.model_version("rule_score", 2021)
    stored = checks.stored_score_count(rows, df, version, 2021).first().row_count
    assert stored == good["row_count"]


def test_log_loss_sums_rows_where_they_are(spark, monkeypatch):
    import numpy as np

    def refuse(*_):
        raise AssertionError("rows are copied for each year")

    monkeypatch.setattr(scoring, "_copies_by_year", refuse)
    made = [(2000 + i % 3, i % 2, float(i % 7), i / 10) for i in range(60)]
    rows = spark.createDataFrame(made, f"year int, {scoring.LABEL} int, a double, b double")
    numbers = {"_mean_a": 3.0, "_mean_b": 2.0, "_scale_a": 2.0, "_scale_b": 1.5, "_coefficient_a": 0.3, "_coefficient_b": -0.2}
    values = {year: {**numbers, "_intercept": 0.1, "_positive": 1.5, "_negative": 0.5} for year in (2001, 2002)}
    found = scoring._log_loss(rows, values, ["a", "b"])
    for year in values:
        seen = [row for row in made if row[0] < year]
        x = np.array([[(a - 3.0) / 2.0, (b - 2.0) / 1.5, 1.0] for _, _, a, b in seen])
        y, total = np.array([row[1] for row in seen]), x @ [0.3, -0.2, 0.1]
        p, weight = 1 / (1 + np.exp(-total)), np.where(y == 1, 1.5, 0.5)
        loss, gradient, hessian = found[year]
        assert np.isclose(loss, np.mean(weight * (np.log1p(np.exp(total)) - y * total)))
        assert np.allclose(gradient, (weight * (p - y)) @ x / len(y))
        assert np.allclose(hessian, x.T @ (x * (weight * p * (1 - p))[:, None]) / len(y))
