"""Rule and logistic risk scores with their top drivers.

Only bounds, scaler values and coefficients (a few numbers per feature) reach
the driver; rows are scored with column expressions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.operators.ordering import exact_quantiles
from periodlens.operators.panel import FEATURES, LABEL

# Band limits, rule weights, quantiles and driver wording.
BAND_LIMITS = {"Low": 0.25, "Medium": 0.50, "High": 0.75}
TOP_BAND = "Critical"

RULE_WEIGHTS = {
    "feat_incident_rate_per_200k_hours": 0.18,
    "feat_prior_incident_count": 0.10,
    "feat_rolling_4q_incident_count": 0.10,
    "feat_prior_violation_count": 0.08,
    "feat_rolling_4q_violation_count": 0.10,
    "feat_ss_share": 0.10,
    "feat_production_efficiency_qoq_delta": 0.12,
    "feat_violation_burden_qoq_delta": 0.08,
    "feat_deterioration_streak_count": 0.06,
}
# Weight of the penalty feature, which the panel does not hold yet.
PENALTY_FEATURE = "feat_assessed_penalty_amount_lag1"
PENALTY_WEIGHT = 0.08

LOWER_QUANTILE = 0.05
UPPER_QUANTILE = 0.95
NEGATIVE_DIRECTION = frozenset({"feat_production_efficiency_qoq_delta"})

RULE_DRIVERS = {
    "feat_incident_rate_per_200k_hours": "Elevated incident rate",
    "feat_prior_incident_count": "Recent incident count remained elevated",
    "feat_rolling_4q_incident_count": "Sustained 4-quarter incident history",
    "feat_prior_violation_count": "Recent violation count remained elevated",
    "feat_rolling_4q_violation_count": "Sustained 4-quarter violation burden",
    "feat_ss_share": "High S&S violation share",
    "feat_assessed_penalty_amount_lag1": "Large prior penalty burden",
    "feat_production_efficiency_qoq_delta": "Production efficiency deteriorated",
    "feat_violation_burden_qoq_delta": "Violation burden worsened QoQ",
    "feat_deterioration_streak_count": "Multi-quarter deterioration streak",
}

LOGISTIC_DRIVERS = {
    "feat_prior_incident_count": "Recent incident history increased risk",
    "feat_rolling_4q_incident_count": "Sustained incident history increased risk",
    "feat_prior_lost_day_incident_count": "Lost-day incident history increased risk",
    "feat_incident_rate_per_200k_hours": "Current incident rate increased risk",
    "feat_prior_violation_count": "Recent violation history increased risk",
    "feat_rolling_4q_violation_count": "Sustained violation burden increased risk",
    "feat_ss_share": "S&S share increased risk",
    "feat_assessed_penalty_amount_lag1": "Penalty burden increased risk",
    "feat_production_per_employee_hour": "Low production efficiency increased risk",
    "feat_production_efficiency_qoq_delta": "Production efficiency trend weakened",
    "feat_violation_burden_qoq_delta": "Violation burden trend worsened",
    "feat_deterioration_streak_count": "Deterioration streak increased risk",
}

DRIVER_COLUMNS = ("top_driver_1", "top_driver_2", "top_driver_3")


class SingleClassError(ValueError):
    """The training rows hold only one outcome."""


@dataclass(frozen=True)
class SplitStats:
    """Size and class balance of one training / validation split."""

    train_rows: int
    train_positives: int
    first_train_year: int | None
    last_train_year: int | None
    valid_rows: int
    valid_positives: int


@dataclass(frozen=True)
class Scored:
    """Scored rows of all validation years with what was fitted per year."""

    rows: DataFrame
    model_name: str
    versions: dict[int, str]
    splits: dict[int, SplitStats]
    fitted: dict[int, dict]
    models: dict[int, LogisticRegressionModel] = field(default_factory=dict)


def model_version(name: str, validation_year: int, tag: str | None = None) -> str:
    tagged = f"{name}_v1_{tag}" if tag else f"{name}_v1"
    return f"{tagged}_train_to_{validation_year - 1}_validate_{validation_year}"


def split_stats(training: DataFrame, years: Sequence[int]) -> dict[int, SplitStats]:
    """Counts of both sides of every split, in one pass."""
    by_year = (
        training.where(F.col("year") <= max(years))
        .groupBy("year")
        .agg(F.count("*").alias("rows"), F.count_if(F.col(LABEL) == 1).alias("positives"))
        .collect()  # one row per calendar year
    )
    stats = {}
    for year in years:
        train = [r for r in by_year if r["year"] < year]
        valid = [r for r in by_year if r["year"] == year]
        stats[year] = SplitStats(
            train_rows=sum(r["rows"] for r in train),
            train_positives=sum(r["positives"] for r in train),
            first_train_year=min((r["year"] for r in train), default=None),
            last_train_year=max((r["year"] for r in train), default=None),
            valid_rows=sum(r["rows"] for r in valid),
            valid_positives=sum(r["positives"] for r in valid),
        )
    return stats


def require_usable(stats: Mapping[int, SplitStats]) -> None:
    """Raise if a split is empty or its training rows hold one class only."""
    for year, split in stats.items():
        if not split.train_rows or not split.valid_rows:
            raise ValueError(f"training or validation set of {year} is empty")
        if split.train_positives in (0, split.train_rows):
            raise SingleClassError(f"training data before {year} holds only one class")


def impute_zero(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})


def risk_band(score: Column) -> Column:
    """Band of the unrounded score."""
    band = F.lit(TOP_BAND)
    for name, limit in reversed(BAND_LIMITS.items()):
        band = F.when(score < limit, name).otherwise(band)
    return band


def top_drivers(
    contributions: Mapping[str, Column], wording: Mapping[str, str], positives_first: bool
) -> list[Column]:
    """The three leading contributions as text; ties keep feature order.

    ``positives_first`` lists positive contributions by size, then the others
    by absolute size.
    """
    entries = []
    for place, (feature, value) in enumerate(contributions.items()):
        keys = [(-value).alias("key")]
        if positives_first:
            keys = [F.when(value > 0, 0).otherwise(1).alias("side"), (-F.abs(value)).alias("key")]
        text = F.lit(wording.get(feature, feature)).alias("text")
        entries.append(F.struct(*keys, F.lit(place).alias("place"), text))
    ordered = F.sort_array(F.array(*entries))
    return [F.get(ordered, F.lit(i))["text"].alias(name) for i, name in enumerate(DRIVER_COLUMNS)]


def _with_year_values(training: DataFrame, values: Mapping[int, Mapping[str, float]]) -> DataFrame:
    """Rows of the validation years with the fitted values of their year.

    The values are a few numbers per feature and year, listed by the driver, so
    their broadcast does not grow with the data. A shuffle by year would put
    all rows into a handful of tasks.
    """
    names = sorted({name for fitted in values.values() for name in fitted})
    schema = ", ".join(["year int", *[f"`{name}` double" for name in names]])
    rows = [(year, *[float(fitted[name]) for name in names]) for year, fitted in values.items()]
    fitted = training.sparkSession.createDataFrame(rows, schema)
    return training.where(F.col("year").isin(*values)).join(F.broadcast(fitted), "year")


def _score_rows(
    valid: DataFrame,
    contributions: Mapping[str, Column],
    score: Callable[[Column], Column],
    wording: Mapping[str, str],
    positives_first: bool,
    versions: Mapping[int, str],
) -> DataFrame:
    """Score from the sum of contributions, with band and drivers."""
    # Contributions become columns first so that none is computed twice.
    held = valid.withColumns({f"_part_{name}": value for name, value in contributions.items()})
    parts = {name: F.col(f"_part_{name}") for name in contributions}
    version = F.lit(None).cast("string")
    for year, text in versions.items():
        version = F.when(F.col("year") == year, text).otherwise(version)
    return held.withColumn("risk_score", score(reduce(add, parts.values()))).select(
        "mine_key",
        "period_key",
        version.alias("model_version"),
        "risk_score",
        risk_band(F.col("risk_score")).alias("risk_band"),
        *top_drivers(parts, wording, positives_first),
        F.col(LABEL).alias("label_next_period"),
        "year",
    )


def rule_bounds(
    training: DataFrame, years: Sequence[int], features: Sequence[str] = tuple(RULE_WEIGHTS)
) -> DataFrame:
    """Exact outer quantiles per feature over the years before each validation year.

    A value is one row, with its copies before each validation year beside it,
    so the rows that are sorted do not depend on the number of years.
    """
    imputed = impute_zero(training.where(F.col("year") < max(years)), features)
    pairs = F.array(
        *[F.struct(F.lit(f).alias("name"), F.col(f).cast("double").alias("value")) for f in features]
    )
    copies = {f"before_{year}": F.count_if(F.col("year") < year) for year in years}
    counted = (
        imputed.select("year", F.explode(pairs).alias("pair"))
        .select("year", "pair.*")
        .where(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(*[count.alias(name) for name, count in copies.items()])
    )
    fractions = {"p05": LOWER_QUANTILE, "p95": UPPER_QUANTILE}
    found = exact_quantiles(counted, ["name"], fractions, list(copies))
    one = len(copies) == 1
    rows = [
        F.struct(
            F.lit(year).alias("validation_year"),
            *[F.col(label if one else f"before_{year}_{label}").alias(label) for label in fractions],
        )
        for year in years
    ]
    return (
        found.select("name", F.explode(F.array(*rows)).alias("row"))
        .select("row.validation_year", "name", "row.p05", "row.p95")
        .where("p05 IS NOT NULL")
    )


def _rule_contribution(feature: str, weight: float) -> Column:
    """Winsorised min-max value times weight, reversed where less is worse."""
    low, high = F.col(f"_low_{feature}"), F.col(f"_high_{feature}")
    clipped = F.greatest(F.least(F.col(feature), high), low)
    share = F.when(high != low, (clipped - low) / (high - low)).otherwise(F.lit(0.0))
    if feature in NEGATIVE_DIRECTION:
        share = F.lit(1.0) - share
    return share * F.lit(float(weight))


def score_rule(
    training: DataFrame,
    years: Sequence[int],
    weights: Mapping[str, float] = RULE_WEIGHTS,
    name: str = "rule_score",
) -> Scored:
    """Weighted rule score of each validation year, bounds from earlier years."""
    missing = [f for f in weights if f not in training.columns]
    if missing:
        raise ValueError(f"features of the rule missing from the panel: {missing}")
    splits = split_stats(training, years)
    require_usable(splits)
    # One row per validation year and configured feature.
    bounds = rule_bounds(training, years, list(weights)).collect()
    values: dict[int, dict[str, float]] = {year: {} for year in years}
    fitted = {
        year: {"active_features": list(weights), "weights": dict(weights), "normalization_bounds": {}}
        for year in years
    }
    for row in bounds:
        year, feature = row["validation_year"], row["name"]
        values[year] |= {f"_low_{feature}": row["p05"], f"_high_{feature}": row["p95"]}
        fitted[year]["normalization_bounds"][feature] = {"p05": row["p05"], "p95": row["p95"]}
    valid = impute_zero(_with_year_values(training, values), list(weights))
    contributions = {f: _rule_contribution(f, weight) for f, weight in weights.items()}
    versions = {year: model_version(name, year) for year in years}
    rows = _score_rows(valid, contributions, lambda total: total, RULE_DRIVERS, False, versions)
    return Scored(rows, name, versions, splits, fitted)


def population_scaler(
    training: DataFrame, years: Sequence[int], features: Sequence[str]
) -> dict[int, dict[str, tuple[float, float]]]:
    """Mean and population deviation per split and feature; a constant gets scale 1."""
    measures = []
    for year in years:
        for i, feature in enumerate(features):
            seen = F.when(F.col("year") < year, F.col(feature))
            measures += [F.avg(seen).alias(f"mean_{year}_{i}"), F.stddev_pop(seen).alias(f"scale_{year}_{i}")]
    row = training.where(F.col("year") < max(years)).agg(*measures).first()
    return {
        year: {f: (row[f"mean_{year}_{i}"], row[f"scale_{year}_{i}"] or 1.0) for i, f in enumerate(features)}
        for year in years
    }


def _copies_by_year(imputed: DataFrame, years: Iterable[int], features: Sequence[str]) -> DataFrame:
    """Each training row once for every one of the years that are after its own."""
    later = F.filter(F.array(*[F.lit(year) for year in years]), lambda year: year > F.col("year"))
    return imputed.select(F.explode(later).alias("year"), F.col(LABEL).cast("double").alias(LABEL), *features)


def _class_weights(split: SplitStats) -> dict[str, float]:
    """Balanced weights, which sum to the row count."""
    return {
        "_positive": split.train_rows / (2.0 * split.train_positives),
        "_negative": split.train_rows / (2.0 * (split.train_rows - split.train_positives)),
    }


def _log_loss(
    imputed: DataFrame, values: Mapping[int, Mapping[str, float]], features: Sequence[str]
) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Balanced log loss by row, its gradient and its Hessian at the coefficients of each year.

    One pass for all years: a task sums its rows in numpy, batch by batch, and
    gives its sums of each year, some squared number of features, to a shuffle.
    """
    size = len(features) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {year: np.zeros(2 + size + size * size) for year in values}
        for batch in batches:
            years, label, *columns = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            raw = np.column_stack(columns)
            for year, fitted in values.items():
                seen = years < year
                mean, scale, coefficient = (
                    np.array([fitted[f"_{part}_{f}"] for f in features]) for part in ("mean", "scale", "coefficient")
                )
                x = np.column_stack([(raw[seen] - mean) / scale, np.ones(np.count_nonzero(seen))])
                y, total = label[seen], x @ np.append(coefficient, fitted["_intercept"])
                weight = np.where(y == 1, fitted["_positive"], fitted["_negative"])
                with np.errstate(over="ignore"):
                    probability = 1.0 / (1.0 + np.exp(-total))
                loss = weight * (np.log1p(np.exp(-np.abs(total))) + np.maximum(total, 0.0) - y * total)
                bent = x * (weight * probability * (1.0 - probability))[:, None]
                error = weight * (probability - y)
                found[year] += np.concatenate([[len(y), loss.sum()], error @ x, (x.T @ bent).ravel()])
        for year, numbers in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([year] * len(numbers), pa.int32()), pa.array(range(len(numbers)), pa.int32()), pa.array(numbers)],
                ["year", "place", "value"],
            )

    rows = imputed.where((F.col("year") < max(values)) & F.col(LABEL).isNotNull()).select(
        "year", F.col(LABEL).cast("double").alias(LABEL), *features
    )
    by_task = rows.mapInArrow(sums, "year int, place int, value double")
    totals = {year: np.zeros(2 + size + size * size) for year in values}
    # So many numbers for each year, whatever the rows.
    for row in by_task.groupBy("year", "place").agg(F.sum("value").alias("value")).collect():
        totals[row["year"]][row["place"]] = row["value"]
    means = {year: numbers[1:] / numbers[0] for year, numbers in totals.items()}
    return {
        year: (float(found[0]), found[1 : 1 + size], found[1 + size :].reshape(size, size))
        for year, found in means.items()
    }


def fit_logistic(
    imputed: DataFrame,
    scalers: Mapping[int, Mapping[str, tuple[float, float]]],
    splits: Mapping[int, SplitStats],
    c: float = 1.0,
    max_iter: int = 100,
    tol: float = 1e-9,
) -> dict[int, dict]:
    """L2-penalised fit of every year with balanced class weights and a free intercept.

    ``c`` is the inverse penalty on the summed loss; the loss is averaged here,
    hence 1 / (c * rows). Newton's method for all years together: a step reads
    ``imputed`` once, so it should be stored, and years that have ended are left
    out. A step that raises the loss is halved. A year ends when no component
    of its gradient, by row, reaches ``tol``; years that do not end raise.
    """
    features = list(next(iter(scalers.values())))
    # Averages of many rows; what rounding may add to a loss.
    slack = 1e-12
    trial = {year: np.zeros(len(features) + 1) for year in scalers}
    best: dict[int, tuple[float, np.ndarray]] = {}
    ended: dict[int, dict] = {}
    for _ in range(max_iter):
        models = {year: _model(scalers[year], beta) for year, beta in trial.items()}
        values = _logistic_values(models, features)
        weighted = {year: {**numbers, **_class_weights(splits[year])} for year, numbers in values.items()}
        for year, (loss, gradient, hessian) in _log_loss(imputed, weighted, features).items():
            beta = trial[year]
            penalty = np.append(np.full(len(features), 1.0 / (c * splits[year].train_rows)), 0.0)
            loss += float(penalty @ beta**2) / 2.0
            if year in best and not loss <= best[year][0] * (1.0 + slack):
                trial[year] = (best[year][1] + beta) / 2.0
                continue
            best[year] = loss, beta
            gradient = gradient + penalty * beta
            if np.abs(gradient).max() < tol:
                ended[year] = models[year]
                del trial[year]
                continue
            # The shortest step if features depend on each other and the penalty is lost in rounding.
            trial[year] = beta - np.linalg.lstsq(hessian + np.diag(penalty), gradient, rcond=None)[0]
        if not trial:
            return {year: ended[year] for year in scalers}
    raise RuntimeError(f"no fit within {max_iter} steps for {sorted(trial)}")


def _model(scaler: Mapping[str, tuple[float, float]], beta: np.ndarray) -> dict:
    return {
        "scaler_mean": [mean for mean, _ in scaler.values()],
        "scaler_scale": [scale for _, scale in scaler.values()],
        "coefficients": beta[:-1].tolist(),
        "intercept": float(beta[-1]),
    }


def spark_model(spark: SparkSession, model: Mapping) -> LogisticRegressionModel:
    """A fitted year as a model of Spark's, for scaled features, so that it can be saved and loaded as one."""
    numbers = spark._sc._gateway.new_array(spark._jvm.double, len(model["coefficients"]))
    for i, value in enumerate(model["coefficients"]):
        numbers[i] = value
    vector = spark._jvm.org.apache.spark.ml.linalg.Vectors.dense(numbers)
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel("logreg", vector, model["intercept"])
    return LogisticRegressionModel(made)


def score_logistic(
    training: DataFrame,
    years: Sequence[int],
    features: Sequence[str] = FEATURES,
    name: str = "logreg",
    tag: str | None = "mvp11",
    c: float = 1.0,
    max_iter: int = 100,
) -> Scored:
    """Class-1 probability of each validation year, fitted on earlier years.

    ``training`` is read once for each step of the fit, so it should be stored.
    """
    splits = split_stats(training, years)
    require_usable(splits)
    imputed = impute_zero(training, features)
    scalers = population_scaler(imputed, years, features)
    fitted = fit_logistic(imputed, scalers, splits, c, max_iter)
    models = {year: spark_model(training.sparkSession, model) for year, model in fitted.items()}
    versions = {year: model_version(name, year, tag) for year in years}
    rows = _logistic_rows(imputed, fitted, versions, features)
    return Scored(rows, name, versions, splits, fitted, models)


def _logistic_values(fitted: Mapping[int, Mapping], features: Sequence[str]) -> dict[int, dict[str, float]]:
    """The numbers of each year's model by the column names that rows are scored with."""
    prefixes = {"_mean_": "scaler_mean", "_scale_": "scaler_scale", "_coefficient_": "coefficients"}
    return {
        year: {
            **{f"{prefix}{f}": x for prefix, part in prefixes.items() for f, x in zip(features, model[part])},
            "_intercept": model["intercept"],
        }
        for year, model in fitted.items()
    }


def _scaled(feature: str) -> Column:
    return (F.col(feature) - F.col(f"_mean_{feature}")) / F.col(f"_scale_{feature}")


def _probability(total: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-(total + F.col("_intercept"))))


def _logistic_rows(
    imputed: DataFrame, fitted: Mapping[int, Mapping], versions: Mapping[int, str], features: Sequence[str]
) -> DataFrame:
    valid = _with_year_values(imputed, _logistic_values(fitted, features))
    contributions = {f: _scaled(f) * F.col(f"_coefficient_{f}") for f in features}
    return _score_rows(valid, contributions, _probability, LOGISTIC_DRIVERS, True, versions)


def score_with_models(panel: DataFrame, models: Mapping[int, Mapping]) -> DataFrame:
    """Score each year with a stored logistic model, without a fit.

    ``models`` holds the metadata of one model per year, as ``model_metadata``
    makes it. A model whose features differ from the other models', are missing
    from ``panel`` or do not match its scaler and coefficients is refused.
    """
    features = list(next(iter(models.values()))["feature_columns"])
    for year, model in models.items():
        if list(model["feature_columns"]) != features:
            raise ValueError(f"the model of {year} has other features")
        for part in ("scaler_mean", "scaler_scale", "coefficients"):
            if len(model[part]) != len(features):
                raise ValueError(f"{part} of {year} has {len(model[part])} values for {len(features)} features")
        if 0.0 in model["scaler_scale"]:
            raise ValueError(f"the scaler of {year} divides by zero")
    missing = [f for f in features if f not in panel.columns]
    if missing:
        raise ValueError(f"features of the model missing from the panel: {missing}")
    versions = {year: model["model_version"] for year, model in models.items()}
    return _logistic_rows(impute_zero(panel, features), models, versions, features)


def logistic_gradients(
    training: DataFrame, scored: Scored, features: Sequence[str] = FEATURES, c: float = 1.0
) -> DataFrame:
    """Largest absolute component of the loss gradient at each year's fitted model.

    The loss is what ``fit_logistic`` minimises: balanced log loss plus the L2
    penalty, by row. All years are summed in one pass; a training row is copied
    to the years after its own before the sums, which are made map-side.
    """
    values = {
        year: {
            **model,
            **_class_weights(split),
        }
        for (year, model), split in zip(_logistic_values(scored.fitted, features).items(), scored.splits.values())
    }
    copies = _copies_by_year(impute_zero(training, features), values, features)
    total = reduce(add, [_scaled(f) * F.col(f"_coefficient_{f}") for f in features])
    weight = F.when(F.col(LABEL) == 1, F.col("_positive")).otherwise(F.col("_negative"))
    rows = _with_year_values(copies, values).withColumn("_error", weight * (_probability(total) - F.col(LABEL)))
    parts = {f: F.avg(F.col("_error") * _scaled(f)) for f in features}
    penalty = {f: F.max(f"_coefficient_{f}") / (c * F.count("*")) for f in features}
    components = [F.abs(parts[f] + penalty[f]) for f in features] + [F.abs(F.avg("_error"))]
    return rows.groupBy("year").agg(
        F.count("*").alias("n_train_rows"),
        F.count_if(F.col(LABEL) == 1).alias("n_train_positives"),
        F.greatest(*components).alias("largest_gradient"),
    )


def stored_scores(scored: DataFrame, predicted_at: dt.datetime) -> DataFrame:
    """Rows for the score table; the score is rounded as the table stores it."""
    return scored.select(
        "mine_key",
        "period_key",
        "model_version",
        F.col("risk_score").cast("decimal(8,5)").alias("risk_score"),
        "risk_band",
        *DRIVER_COLUMNS,
        "label_next_period",
        F.lit(predicted_at).cast("timestamp").alias("prediction_ts"),
    )


def model_metadata(scored: Scored, year: int, features: Sequence[str] = FEATURES) -> dict:
    """What the stored model of a year needs to be understood later."""
    split = scored.splits[year]
    return {
        "model_version": scored.versions[year],
        "model_name": scored.model_name,
        "train_end_year": year - 1,
        "validation_year": year,
        "target_column": LABEL,
        "feature_columns": list(features),
        "row_count_train": split.train_rows,
        "row_count_validation": split.valid_rows,
        "positive_rate_train": split.train_positives / split.train_rows,
        "positive_rate_validation": split.valid_positives / split.valid_rows,
        "risk_band_thresholds": {name.lower(): limit for name, limit in BAND_LIMITS.items()},
        "config_version": 1,
        **scored.fitted[year],
    }
