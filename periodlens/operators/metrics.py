"""Backtest metrics per model version and validation year.

Input rows carry ``model_version``, ``year``, ``mine_key``, ``period_key``,
``risk_score`` and ``label_next_period``. All groups are handled in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.functions.numbers import guarded_ratio
from periodlens.operators.ordering import rank_rows, running_totals

SPLIT = ("model_version", "year")
TOP_FRACTION = 0.10


def rank_scores(scored: DataFrame) -> DataFrame:
    """Rank by score, ties by mine and period; adds ``score_rank`` and ``split_rows``."""
    return rank_rows(
        scored, SPLIT, [F.desc("risk_score"), "mine_key", "period_key"], "score_rank", "split_rows"
    )


def top_fraction_metrics(scored: DataFrame, fraction: float = TOP_FRACTION) -> DataFrame:
    """Precision, recall and lift among the highest-scored share of rows."""
    label = F.col("label_next_period")
    size = F.greatest(F.lit(1), F.ceil(F.lit(fraction) * F.col("split_rows")))
    counted = (
        rank_scores(scored.select(*SPLIT, "mine_key", "period_key", "risk_score", "label_next_period"))
        .groupBy(*SPLIT)
        .agg(
            F.count("*").alias("n_validation_rows"),
            F.sum(label.cast("long")).alias("n_validation_positives"),
            F.max(size).cast("long").alias("top_decile_size"),
            F.count_if((F.col("score_rank") <= size) & (label == 1)).alias("top_decile_positive_count"),
        )
    )
    positives, rows = F.col("n_validation_positives"), F.col("n_validation_rows")
    inside, size = F.col("top_decile_positive_count"), F.col("top_decile_size")
    return counted.withColumns(
        {
            "base_rate": guarded_ratio(positives, rows),
            "precision_at_top_decile": guarded_ratio(inside, size),
            "recall_at_top_decile": guarded_ratio(inside, positives),
        }
    ).withColumn("lift_vs_base_rate", guarded_ratio(F.col("precision_at_top_decile"), F.col("base_rate")))


def ranking_quality(scored: DataFrame) -> DataFrame:
    """ROC-AUC and average precision per split; NULL when one class is missing.

    Works on one row per distinct score, so ties count half in the former and
    form one step in the latter. Pair counts stay exact integers.
    """
    label = F.col("label_next_period")
    by_score = scored.groupBy(*SPLIT, "risk_score").agg(
        F.count("*").alias("rows_here"), F.count_if(label == 1).alias("positives_here")
    )
    ranked = running_totals(
        by_score, SPLIT, [F.desc("risk_score")], {"rows": "rows_here", "positives": "positives_here"}
    )
    negatives_here = (F.col("rows_here") - F.col("positives_here")).cast("decimal(19,0)")
    above = F.col("positives") - F.col("positives_here")
    twice_won = negatives_here * (2 * above + F.col("positives_here")).cast("decimal(19,0)")
    step = F.col("positives_here") * (F.col("positives") / F.col("rows"))
    totals = ranked.groupBy(*SPLIT).agg(
        F.sum(twice_won).alias("twice_won"),
        F.sum(step).alias("steps"),
        F.max("positives_all").alias("positives"),
        F.max(F.col("rows_all") - F.col("positives_all")).alias("negatives"),
    )
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    pairs = 2.0 * F.col("positives") * F.col("negatives")
    return totals.select(
        *SPLIT,
        F.when(both, F.col("twice_won").cast("double") / pairs).alias("roc_auc"),
        F.when(both, F.col("steps") / F.col("positives")).alias("pr_auc"),
    )


def split_metrics(scored: DataFrame, fraction: float = TOP_FRACTION) -> DataFrame:
    """All metrics, one row per model version and year."""
    return top_fraction_metrics(scored, fraction).join(ranking_quality(scored), list(SPLIT))


def model_summary(splits: DataFrame) -> DataFrame:
    """Per model: mean over its splits (NULLs left out) and pooled ratios."""
    macro = ("roc_auc", "pr_auc", "precision_at_top_decile", "recall_at_top_decile", "lift_vs_base_rate")
    pooled = {
        "pooled_validation_rows": "n_validation_rows",
        "pooled_validation_positives": "n_validation_positives",
        "pooled_top_decile_size": "top_decile_size",
        "pooled_top_decile_positive_count": "top_decile_positive_count",
    }
    summed = splits.groupBy("model_name").agg(
        F.count("*").alias("n_splits"),
        *[F.avg(name).alias(f"macro_{name}") for name in macro],
        *[F.sum(source).cast("long").alias(name) for name, source in pooled.items()],
    )
    inside = F.col("pooled_top_decile_positive_count")
    positives = F.col("pooled_validation_positives")
    return summed.withColumns(
        {
            "pooled_base_rate": guarded_ratio(positives, F.col("pooled_validation_rows")),
            "pooled_precision_at_top_decile": guarded_ratio(inside, F.col("pooled_top_decile_size")),
            "pooled_recall_at_top_decile": guarded_ratio(inside, positives),
        }
    ).withColumn(
        "pooled_lift_vs_base_rate",
        guarded_ratio(F.col("pooled_precision_at_top_decile"), F.col("pooled_base_rate")),
    )
