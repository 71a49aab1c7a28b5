"""Model evaluation and error analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstride.constants import FOREST_THRESHOLD, HALF_THRESHOLD, SEED, TEST_RATIO
from tabstride.operators.columns import apply_threshold, positive_prob
from tabstride.operators.forest import predict_forest
from tabstride.operators.metrics import (
    auc_of,
    checked_class,
    checked_score,
    classification_report,
    compare_thresholds,
    confusion_matrix,
    error_counts,
    pr_points,
    ranked_scores,
    roc_points,
    sweep_f1,
    weighted_metrics,
)
from tabstride.operators.splits import random_split, sample_errors
from tabstride.session import materialize
from tabstride.sources.artefacts import load_forest


def decided(model, df: DataFrame, t: float = FOREST_THRESHOLD) -> DataFrame:
    """Predictions with ``prob`` of class 1 and ``custom_prediction`` at threshold ``t``."""
    scored = positive_prob(predict_forest(model, df), "prob")
    return apply_threshold(scored, "prob", t, "custom_prediction")


def _outcomes(scored: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Row counts per distinct score and outcome, stored once for all metrics."""
    keys = [checked_class(c).alias(c) for c in ("label", *extra)]
    return materialize(
        scored.groupBy(*keys, checked_score("prob").alias("prob")).agg(
            F.count(F.lit(1)).alias("copies")
        )
    )


def evaluate(model, df: DataFrame, t: float = FOREST_THRESHOLD) -> DataFrame:
    """One row: accuracy and weighted F1 at ``t``, exact ROC area.  The model runs once."""
    scored = positive_prob(predict_forest(model, df), "prob").select("label", "prob")
    outcomes = apply_threshold(_outcomes(scored, []), "prob", t, "custom_prediction")
    quality = weighted_metrics(outcomes, prediction="custom_prediction", weight="copies")
    area = auc_of(ranked_scores(outcomes, weight="copies"))
    return quality.crossJoin(F.broadcast(area))


def error_report(
    scored: DataFrame,
    key: str = "id",
    samples: int = 5,
    thresholds: Sequence[float] = (HALF_THRESHOLD, FOREST_THRESHOLD),
    seed: int = SEED,
) -> dict[str, DataFrame]:
    """All error-analysis tables of a set with ``key, label, prob, prediction``.

    The scored rows are read once into counts per distinct score; only the samples read
    them again, so store them first if scoring is costly.
    """
    outcomes = _outcomes(scored, ["prediction"])
    ranked = ranked_scores(outcomes, weight="copies")
    slim = scored.select(key, "label", "prob", "prediction")
    return {
        "confusion_matrix": confusion_matrix(outcomes, weight="copies"),
        "classification_report": classification_report(outcomes, weight="copies"),
        "error_counts": error_counts(outcomes, weight="copies"),
        "error_samples": sample_errors(slim, samples, key, seed=seed),
        "roc_curve": roc_points(ranked),
        "roc_auc": auc_of(ranked),
        "pr_curve": pr_points(ranked),
        "best_threshold": sweep_f1(outcomes, weight="copies"),
        "compare_thresholds": compare_thresholds(outcomes, thresholds, weight="copies"),
    }


def saved_error_report(
    path: str,
    df: DataFrame,
    key: str = "id",
    test_ratio: float = TEST_RATIO,
    seed: int = SEED,
    **options,
) -> dict[str, DataFrame]:
    """``error_report`` of a saved forest on the test part of the prepared rows it was fitted from.

    With the key, ratio and seed of the training, the split gives the same test part.  The
    forest scores these rows once; ``prediction`` is its own class.
    """
    _, test = random_split(df, key, test_ratio, seed)
    scored = positive_prob(predict_forest(load_forest(path), test), "prob").select(
        key, "label", "prob", F.col("prediction").cast("int").alias("prediction")
    )
    return error_report(materialize(scored), key, seed=seed, **options)
