"""Training flows that keep what they made: models, predictions, params and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstride.constants import DEFAULT_FEATURES, FOREST_THRESHOLD, NET_THRESHOLD, SEED, TEST_RATIO
from tabstride.operators.columns import apply_threshold
from tabstride.operators.forest import best_params
from tabstride.operators.metrics import auc_of, binary_metrics, ranked_scores, weighted_metrics
from tabstride.operators.net import mlp_fit, mlp_score
from tabstride.operators.scaling import apply_fitted, fit_scaler
from tabstride.operators.splits import stratified_split
from tabstride.plans.evaluation import decided
from tabstride.sources.artefacts import (
    log_metrics_table,
    log_run,
    save_features,
    save_forest,
    save_net,
    save_scaler,
)


def train_net(
    df: DataFrame,
    path: str,
    run_id: str,
    feats: Sequence[str] = DEFAULT_FEATURES,
    label: str = "label",
    key: str = "id",
    t: float = NET_THRESHOLD,
    test_ratio: float = TEST_RATIO,
    seed: int = SEED,
    **training,
) -> DataFrame:
    """Split by label, scale on the train part, fit a net, score the test part, keep all of it.

    Under ``path`` it writes ``scaler``, ``features``, ``net``, ``predictions`` and appends to
    ``runs``.  Returns the predictions: key, label, ``prob`` and ``prediction`` at ``t``.
    """
    spark = df.sparkSession
    rows = df.select(key, label, *feats)
    stratified_split(rows, label, key, test_ratio, seed).write.parquet(f"{path}/split")
    split = spark.read.parquet(f"{path}/split")
    train, test = split.filter("NOT is_test"), split.filter("is_test")
    scaler = fit_scaler(train, feats, ddof=0)
    inputs = apply_fitted(train, scaler, constant="one")
    weights, losses = mlp_fit(inputs, feats, label, key, seed=seed, **training)
    save_scaler(spark, scaler, f"{path}/scaler")
    save_features(spark, feats, f"{path}/features")
    save_net(spark, weights, f"{path}/net")

    scored = mlp_score(apply_fitted(test, scaler, constant="one"), feats, weights, "prob")
    answer = apply_threshold(scored, "prob", t, "prediction")
    answer.select(key, label, "prob", "prediction").write.parquet(f"{path}/predictions")
    predictions = spark.read.parquet(f"{path}/predictions")
    quality = binary_metrics(predictions, t, label).crossJoin(
        F.broadcast(auc_of(ranked_scores(predictions, label=label)))
    )
    params = {"epochs": len(losses), "decision_threshold": t, "test_ratio": test_ratio, "seed": seed}
    log_run(spark, f"{path}/runs", run_id, params, {"final_loss": losses[-1]})
    log_metrics_table(quality, f"{path}/runs", run_id)
    return predictions


def evaluate_run(
    model, df: DataFrame, path: str, run_id: str, key: str = "id", t: float = FOREST_THRESHOLD
) -> DataFrame:
    """Predictions of a forest or a finished search, with the run logged and the model kept.

    Under ``path`` it writes ``predictions`` and ``model`` and appends to ``runs``: the decision
    threshold, the best setting of a search, accuracy, weighted F1 and ROC area.  Returns the
    predictions: key, label, ``prob``, ``prediction`` and ``custom_prediction`` at ``t``.
    """
    spark = df.sparkSession
    answer = decided(model, df, t).select(
        key, "label", "prob", F.col("prediction").cast("int").alias("prediction"), "custom_prediction"
    )
    answer.write.parquet(f"{path}/predictions")
    predictions = spark.read.parquet(f"{path}/predictions")
    searched = isinstance(model, CrossValidatorModel)
    params = {"decision_threshold": t, **(best_params(model) if searched else {})}
    log_run(spark, f"{path}/runs", run_id, params)
    quality = weighted_metrics(predictions, prediction="custom_prediction").crossJoin(
        F.broadcast(auc_of(ranked_scores(predictions)))
    )
    log_metrics_table(quality, f"{path}/runs", run_id)
    save_forest(model.bestModel if searched else model, f"{path}/model")
    return predictions
