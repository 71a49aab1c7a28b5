"""Evaluation of binary predictions.

Every metric accepts a ``weight`` column of row counts, so a scored set can be grouped
once by its distinct scores and all metrics read from that smaller table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstride.constants import FOREST_THRESHOLD, HALF_THRESHOLD
from tabstride.functions import column_value
from tabstride.operators.columns import literal_table
from tabstride.operators.running import SINGLE_TASK_ROWS, running_totals

# Threshold grids of the two sweeps.
GRID_HUNDREDTHS = [i / 100 for i in range(1, 100)]
GRID_TWENTIETHS = [0.05 + i * ((0.95 - 0.05) / 18) for i in range(18)] + [0.95]


def _weight(weight: str | None) -> Column:
    return F.lit(1).cast("bigint") if weight is None else F.col(weight)


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 where undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def checked_score(c: str) -> Column:
    """Score as double; a missing score is an error."""
    return F.coalesce(
        column_value(c), F.raise_error(F.lit(f"missing score in column {c}")).cast("double")
    )


def checked_class(c: str) -> Column:
    """Class 0 or 1; anything else, a missing one too, is an error."""
    known = F.when(F.col(c).isin(0, 1), F.col(c))
    wrong = F.raise_error(F.lit(f"class other than 0 and 1 in column {c}"))
    return F.coalesce(known.cast("int"), wrong.cast("int"))


def false_positives(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return df.filter((F.col(label) == 0) & (F.col(prediction) == 1))


def false_negatives(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return df.filter((F.col(label) == 1) & (F.col(prediction) == 0))


def confusion_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """One row ``tp, fp, fn, tn``."""
    w, actual, predicted = _weight(weight), checked_class(label), checked_class(prediction)

    def cell(a: int, p: int) -> Column:
        return F.coalesce(F.sum(F.when((actual == a) & (predicted == p), w)), F.lit(0))

    return df.agg(
        cell(1, 1).alias("tp"),
        cell(0, 1).alias("fp"),
        cell(1, 0).alias("fn"),
        cell(0, 0).alias("tn"),
    )


def error_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Number of false positives and false negatives."""
    return confusion_counts(df, label, prediction, weight).select(
        F.col("fp").alias("false_positives"), F.col("fn").alias("false_negatives")
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """One row per actual class, one column per predicted class, zeros kept."""
    rows = literal_table(
        {"actual": F.lit(0), "predicted_0": F.col("tn"), "predicted_1": F.col("fp")},
        {"actual": F.lit(1), "predicted_0": F.col("fn"), "predicted_1": F.col("tp")},
    )
    return confusion_counts(df, label, prediction, weight).select(rows)


def add_binary_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and class-1 precision, recall and F1 from ``tp, fp, fn, tn``."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *[c for c in counts.columns if c not in ("tp", "fp", "fn", "tn")],
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def binary_metrics(
    df: DataFrame,
    t: float = HALF_THRESHOLD,
    label: str = "label",
    prob: str = "prob",
    weight: str | None = None,
) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1 at threshold ``t`` (inclusive)."""
    decided = df.withColumn("_decision", (checked_score(prob) >= F.lit(float(t))).cast("int"))
    return add_binary_metrics(confusion_counts(decided, label, "_decision", weight))


def _class_rows(counts: DataFrame) -> DataFrame:
    """Counts ``hits, called, support`` of each class, with the totals beside them."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rows = literal_table(
        {"name": F.lit("0"), "hits": tn, "called": tn + fn, "support": tn + fp},
        {"name": F.lit("1"), "hits": tp, "called": tp + fp, "support": tp + fn},
    )
    total, right = (tp + fp + fn + tn).alias("total"), (tp + tn).alias("right")
    return counts.select(total, right, rows).withColumns(
        {
            "precision": _ratio(F.col("hits"), F.col("called")),
            "recall": _ratio(F.col("hits"), F.col("support")),
            "f1": _ratio(2 * F.col("hits"), F.col("called") + F.col("support")),
        }
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Per class, accuracy, macro and weighted means: precision, recall, F1, support.

    The accuracy row carries its value in ``f1``.
    """
    scores = ["precision", "recall", "f1"]
    classes = _class_rows(confusion_counts(df, label, prediction, weight))
    means = classes.agg(
        F.first("total").alias("total"),
        F.first("right").alias("right"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[
            _ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"weighted_{s}")
            for s in scores
        ],
    )
    none, total = F.lit(None).cast("double"), {"support": F.col("total")}
    summary = literal_table(
        {"name": F.lit("accuracy"), "precision": none, "recall": none,
         "f1": _ratio(F.col("right"), F.col("total")), **total},
        {"name": F.lit("macro avg"), **{s: F.col(f"macro_{s}") for s in scores}, **total},
        {"name": F.lit("weighted avg"), **{s: F.col(f"weighted_{s}") for s in scores}, **total},
    )
    return classes.select("name", *scores, "support").unionByName(means.select(summary))


def weighted_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Accuracy and support-weighted F1, in one pass."""
    classes = _class_rows(confusion_counts(df, label, prediction, weight))
    return classes.agg(
        _ratio(F.first("right"), F.first("total")).alias("accuracy"),
        _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
    )


def threshold_counts(
    df: DataFrame,
    grid: Sequence[float],
    label: str = "label",
    prob: str = "prob",
    weight: str | None = None,
) -> DataFrame:
    """``threshold, tp, fp, fn, tn`` for every threshold of a small grid, in one pass.

    Each row falls into one bucket, the number of thresholds at or below its score.  The
    rest works on one count per bucket.
    """
    marks = sorted(set(float(t) for t in grid))
    scored = df.select(
        checked_class(label).alias("label"), checked_score(prob).alias("score"),
        _weight(weight).alias("w"),
    )
    bucketed = Bucketizer(
        splits=[float("-inf"), *marks, float("inf")], inputCol="score", outputCol="place"
    ).transform(scored)
    counts = bucketed.groupBy(F.col("place").cast("int").alias("place")).agg(
        F.sum(F.when(F.col("label") == 1, F.col("w")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("label") == 0, F.col("w")).otherwise(0)).alias("neg"),
    )
    # One row per bucket of the grid, so empty buckets are there too.
    frame = df.sparkSession.range(1).select(
        F.posexplode(F.array(F.lit(None).cast("double"), *[F.lit(t) for t in marks])).alias(
            "place", "threshold"
        )
    )
    upward = Window.orderBy(F.desc("place")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    every = Window.partitionBy()
    pos, neg = F.coalesce("pos", F.lit(0)), F.coalesce("neg", F.lit(0))
    return (
        frame.join(F.broadcast(counts), "place", "left")
        .select(
            "threshold",
            F.sum(pos).over(upward).alias("tp"),
            F.sum(neg).over(upward).alias("fp"),
            F.sum(pos).over(every).alias("all_pos"),
            F.sum(neg).over(every).alias("all_neg"),
        )
        .filter("threshold IS NOT NULL")
        .select(
            "threshold",
            "tp",
            "fp",
            (F.col("all_pos") - F.col("tp")).alias("fn"),
            (F.col("all_neg") - F.col("fp")).alias("tn"),
        )
    )


def compare_thresholds(
    df: DataFrame,
    thresholds: Sequence[float] = (HALF_THRESHOLD, FOREST_THRESHOLD),
    label: str = "label",
    prob: str = "prob",
    weight: str | None = None,
) -> DataFrame:
    """Accuracy, precision, recall and F1 side by side for a few thresholds."""
    return add_binary_metrics(threshold_counts(df, thresholds, label, prob, weight))


def sweep_f1(
    df: DataFrame,
    grid: Sequence[float] = GRID_HUNDREDTHS,
    when_zero: float | None = HALF_THRESHOLD,
    label: str = "label",
    prob: str = "prob",
    weight: str | None = None,
) -> DataFrame:
    """Threshold of the grid with the best F1; the lowest one wins ties.

    If F1 is 0 everywhere the answer is ``when_zero``, or the lowest threshold if None.
    """
    swept = compare_thresholds(df, grid, label, prob, weight)
    best = F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold")))
    top = swept.agg(best.alias("best_threshold"), F.max("f1").alias("best_f1"))
    if when_zero is None:
        return top
    return top.withColumn(
        "best_threshold",
        F.when(F.col("best_f1") > 0, F.col("best_threshold")).otherwise(F.lit(float(when_zero))),
    )


def score_counts(
    df: DataFrame, label: str = "label", prob: str = "prob", weight: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score."""
    w = _weight(weight)
    return df.groupBy(checked_score(prob).alias("score")).agg(
        F.sum(F.when(checked_class(label) == 1, w).otherwise(0)).alias("pos"),
        F.sum(F.when(checked_class(label) == 0, w).otherwise(0)).alias("neg"),
    )


def ranked_scores(
    df: DataFrame,
    label: str = "label",
    prob: str = "prob",
    weight: str | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Distinct scores, highest first, with cumulative and total positives and negatives."""
    ranked = running_totals(
        score_counts(df, label, prob, weight),
        [F.desc("score")],
        ["pos", "neg"],
        single_task_rows=single_task_rows,
    )
    totals = ranked.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    return ranked.crossJoin(F.broadcast(totals))


def roc_points(ranked: DataFrame) -> DataFrame:
    """ROC points of :func:`ranked_scores`, with the origin at threshold infinity."""
    points = ranked.select(
        F.try_divide(F.col("cum_neg").cast("double"), "all_neg").alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), "all_pos").alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = ranked.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return points.unionByName(origin)


def pr_points(ranked: DataFrame) -> DataFrame:
    """Precision-recall points of :func:`ranked_scores`, with the end point (1, 0)."""
    called = F.col("cum_pos") + F.col("cum_neg")
    points = ranked.select(
        (F.col("cum_pos") / called).alias("precision"),
        F.coalesce(
            F.try_divide(F.col("cum_pos").cast("double"), "all_pos"), F.lit(1.0)
        ).alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = ranked.sparkSession.range(1).select(
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"),
    )
    return points.unionByName(end)


def auc_of(ranked: DataFrame) -> DataFrame:
    """Exact ROC area of :func:`ranked_scores`; ties count half, null with one class only."""
    above = (F.col("cum_pos") - F.col("pos")).cast("double") + F.col("pos") / 2.0
    pairs = F.first("all_pos").cast("double") * F.first("all_neg")
    return ranked.agg(F.try_divide(F.sum(F.col("neg") * above), pairs).alias("auc"))


def roc_curve(df: DataFrame, **options) -> DataFrame:
    """``fpr, tpr, threshold`` for every distinct score; no point is dropped."""
    return roc_points(ranked_scores(df, **options))


def pr_curve(df: DataFrame, **options) -> DataFrame:
    """``precision, recall, threshold`` for every distinct score, then (1, 0)."""
    return pr_points(ranked_scores(df, **options))


def roc_auc(df: DataFrame, **options) -> DataFrame:
    """Exact area under the ROC curve."""
    return auc_of(ranked_scores(df, **options))


def trapezoid_auc(
    curve: DataFrame,
    x: str = "fpr",
    y: str = "tpr",
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Trapezoid area under a curve of any length.

    Points are numbered in order and each meets its predecessor by number, an equi-join,
    so the curve never passes through one task.
    """
    points = curve.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(
        F.first(F.lit(1).cast("bigint")).alias("one")
    )
    numbered = running_totals(
        points, [F.col("x"), F.col("y")], ["one"], single_task_rows=single_task_rows
    )
    left = numbered.select(
        (F.col("cum_one") + 1).alias("place"), F.col("x").alias("x0"), F.col("y").alias("y0")
    )
    right = numbered.select(F.col("cum_one").alias("place"), "x", "y")
    area = (F.col("x") - F.col("x0")) * (F.col("y") + F.col("y0")) / 2.0
    return left.join(right, "place").agg(F.sum(area).alias("auc"))
