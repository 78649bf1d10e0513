"""Rolling-year backtest over models and validation years."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.operators import checks, metrics, scoring
from periodlens.plans import reports, warehouse
from periodlens.session import pin
from periodlens.sources.tables import read_metadata, write_claims, write_csv, write_metadata

Scorer = Callable[[DataFrame, Sequence[int]], scoring.Scored]

SCORERS: dict[str, Scorer] = {"rule_score": scoring.score_rule, "logreg": scoring.score_logistic}


@dataclass(frozen=True)
class Backtest:
    """Results of a run; frames are None if every split was skipped."""

    scores: DataFrame | None
    splits: DataFrame | None
    summary: DataFrame | None
    claims: DataFrame | None
    skipped: list[str]


def run_backtest(
    training: DataFrame,
    validation_years: Sequence[int] = (2021,),
    models: Sequence[str] = ("logreg",),
    run_id: str = "backtest",
    top_fraction: float = metrics.TOP_FRACTION,
    min_train_rows: int = 100,
    min_validation_rows: int = 30,
    require_both_classes: bool = True,
    output: str | None = None,
    scorers: Mapping[str, Scorer] = SCORERS,
    store: str | None = None,
    now: dt.datetime | None = None,
) -> Backtest:
    """Fit, score and measure every model on every validation year.

    ``training`` should be pinned: it is read once per fit. Scores of all
    splits that could be fitted are returned; splits below the minimum sizes
    have no metrics. ``output`` names a folder for the report files.
    ``store`` names a warehouse: scores and split metrics are upserted there as
    of ``now``, and what the checks found is stored as quality results.
    """
    unknown = [name for name in models if name not in scorers]
    if unknown:
        raise ValueError(f"unsupported models: {unknown}")
    stats = scoring.split_stats(training, validation_years)
    fittable, skipped = [], []
    for year in validation_years:
        try:
            scoring.require_usable({year: stats[year]})
        except scoring.SingleClassError as error:
            if not require_both_classes:
                raise
            skipped.append(str(error))
            continue
        fittable.append(year)
    if not fittable:
        return Backtest(None, None, None, None, skipped)
    large = [
        year
        for year in fittable
        if stats[year].train_rows >= min_train_rows and stats[year].valid_rows >= min_validation_rows
    ]
    skipped += [f"{year}: too few rows" for year in fittable if year not in large]
    fits = [scorers[name](training, fittable) for name in models]
    scores = pin(reduce(DataFrame.unionByName, [fit.rows for fit in fits]), "backtest-scores")
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    expected = sum(stats[year].valid_rows for year in fittable) * len(models)
    _check_scores(scores, expected, fittable, store, run_id, now)
    if store:
        _store_scores(training, scores, fits, store, run_id, now)
    if output:
        for fit in fits:
            _write_models(training, fit, output)
    if not large:
        return Backtest(scores, None, None, None, skipped)
    measured = scores.where(F.col("year").isin(*large))
    splits = pin(_measure(measured, fits, large, run_id, top_fraction), "backtest-splits")
    if store:
        warehouse.save_backtest(training.sparkSession, store, splits, now, run_id)
    summary = metrics.model_summary(splits)
    claims = reports.claims(summary)
    if output:
        measured.write.mode("overwrite").partitionBy("model_version").option("header", True).csv(
            f"{output}/predictions"
        )
        write_csv(splits, f"{output}/split_metrics")
        write_csv(summary, f"{output}/model_summary")
        write_claims(claims, f"{output}/business_claims")
    return Backtest(scores, splits, summary, claims, skipped)


def _check_scores(
    scores: DataFrame, expected_rows: int, years: Sequence[int], store: str | None, run_id: str, now: dt.datetime
) -> None:
    found = checks.score_checks(scores).unionByName(checks.backtest_checks(scores, years))
    if store:
        spark = scores.sparkSession
        statistics = warehouse.record_checks(spark, store, found, run_id, "scored_rows", now)
    else:
        statistics = checks.raise_on_failures(found, "scored rows")
    if statistics["row_count"] != expected_rows:
        raise ValueError("scored rows differ from validation rows")


def _store_scores(
    training: DataFrame, scores: DataFrame, fits: Sequence[scoring.Scored], store: str, run_id: str, now: dt.datetime
) -> None:
    """Upsert the scores, and compare what is stored of each version with the rows of its year."""
    spark = scores.sparkSession
    warehouse.save_scores(spark, store, scoring.stored_scores(scores, now), now, run_id)
    stored = warehouse.current_table(spark, store, "risk_score")
    for fit in fits:
        for year, version in fit.versions.items():
            rows = checks.stored_score_count(stored, training, version, year).first().row_count
            if rows != fit.splits[year].valid_rows:
                raise ValueError(f"{version}: {rows} stored scores for {fit.splits[year].valid_rows} rows")


def score_from_models(panel: DataFrame, output: str, versions: Mapping[int, str]) -> DataFrame:
    """Score years of a panel with the models that an earlier run wrote to ``output``."""
    paths = {year: f"{output}/models/{version}/metadata" for year, version in versions.items()}
    models = {year: read_metadata(panel.sparkSession, path) for year, path in paths.items()}
    return scoring.score_with_models(panel, models)


def _measure(
    scores: DataFrame, fits: Sequence[scoring.Scored], years: Sequence[int], run_id: str, top_fraction: float
) -> DataFrame:
    # One row per split.
    facts = scores.sparkSession.createDataFrame(
        [
            (
                run_id,
                fit.model_name,
                fit.versions[year],
                fit.splits[year].first_train_year,
                fit.splits[year].last_train_year,
                fit.splits[year].train_rows,
            )
            for fit in fits
            for year in years
        ],
        "backtest_run_id string, model_name string, model_version string, train_start_year int, "
        "train_end_year int, n_train_rows long",
    )
    return metrics.split_metrics(scores, top_fraction).join(facts, "model_version").select(
        "backtest_run_id",
        "model_name",
        "model_version",
        "train_start_year",
        "train_end_year",
        F.col("year").alias("validation_year"),
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
    )


def _write_models(training: DataFrame, fit: scoring.Scored, output: str) -> None:
    built_at = dt.datetime.now(dt.timezone.utc).isoformat()
    for year, version in fit.versions.items():
        metadata = {**scoring.model_metadata(fit, year), "built_at": built_at}
        write_metadata(training.sparkSession, metadata, f"{output}/models/{version}/metadata")
        if year in fit.models:
            fit.models[year].write().overwrite().save(f"{output}/models/{version}/model")
