"""Checks of metrics on the scored view."""

from __future__ import annotations

from checks.views import rounded, scored, with_v3
from tabstride.operators import metrics as M
from tabstride.plans import error_report


def on_scores(operator, **options):
    return lambda spark, sf: rounded(operator(scored(spark, sf), **options))


def report(part):
    """One table of the composed error analysis."""
    return lambda spark, sf: rounded(error_report(scored(spark, sf))[part])


QUERIES = {
    "confusion_matrix": on_scores(M.confusion_matrix),
    "classification_report": on_scores(M.classification_report),
    "binary_metrics": on_scores(M.binary_metrics, t=0.5),
    "binary_metrics_net": on_scores(M.binary_metrics, t=0.35),
    "weighted_metrics": on_scores(M.weighted_metrics),
    "threshold_counts": on_scores(M.threshold_counts, grid=M.GRID_HUNDREDTHS),
    "compare_thresholds": on_scores(M.compare_thresholds),
    "sweep_f1": on_scores(M.sweep_f1),
    "sweep_f1_twentieths": on_scores(M.sweep_f1, grid=M.GRID_TWENTIETHS, when_zero=None),
    "roc_auc": on_scores(M.roc_auc),
    "roc_curve": on_scores(M.roc_curve),
    "trapezoid_auc": lambda spark, sf: rounded(
        M.trapezoid_auc(M.roc_curve(scored(spark, sf)))
    ),
    "pr_curve": on_scores(M.pr_curve),
    "error_report_confusion": report("confusion_matrix"),
    "error_report_classes": report("classification_report"),
    "error_report_counts": report("error_counts"),
    "error_report_samples": report("error_samples"),
    "error_report_roc_curve": report("roc_curve"),
    "error_report_roc_auc": report("roc_auc"),
    "error_report_pr_curve": report("pr_curve"),
    "error_report_best_threshold": report("best_threshold"),
    "error_report_thresholds": report("compare_thresholds"),
}


def _metrics(t: str) -> str:
    return f"""
SELECT round((tp+tn)/(tp+fp+fn+tn), 6) AS accuracy, round(tp/(tp+fp), 6) AS precision,
       round(tp/(tp+fn), 6) AS recall, round(2*tp/(2*tp+fp+fn), 6) AS f1
FROM (SELECT count(*) FILTER (prob >= {t} AND label=1) AS tp,
             count(*) FILTER (prob >= {t} AND label=0) AS fp,
             count(*) FILTER (prob < {t} AND label=1) AS fn,
             count(*) FILTER (prob < {t} AND label=0) AS tn FROM v3) c"""


def _grid(values: str) -> str:
    """Counts per threshold of a one-column table expression ``t(threshold)``."""
    return f"""
SELECT threshold, count(*) FILTER (prob >= threshold AND label=1) AS tp,
       count(*) FILTER (prob >= threshold AND label=0) AS fp,
       count(*) FILTER (prob < threshold AND label=1) AS fn,
       count(*) FILTER (prob < threshold AND label=0) AS tn
FROM v3 CROSS JOIN ({values}) t GROUP BY threshold"""


_HUNDREDTHS = "SELECT i/100 AS threshold FROM range(1, 100) r(i)"
_TWENTIETHS = "SELECT unnest([{}]) AS threshold".format(
    ", ".join(f"{t!r}::double" for t in M.GRID_TWENTIETHS)
)


def _best(values: str) -> str:
    return with_v3(f"""
SELECT round(threshold, 6) AS best_threshold, round(f1, 6) AS best_f1
FROM (SELECT threshold, 2*tp/(2*tp+fp+fn) AS f1 FROM ({_grid(values)}) g)
ORDER BY f1 DESC, threshold LIMIT 1""")


_CLASSES = """
SELECT name, support, hits/called AS precision, hits/support AS recall,
       2*hits/(called+support) AS f1, hits
FROM (SELECT '0' AS name, count(*) FILTER (label=0) AS support,
             count(*) FILTER (prediction=0) AS called,
             count(*) FILTER (label=0 AND prediction=0) AS hits FROM v3
      UNION ALL
      SELECT '1', count(*) FILTER (label=1), count(*) FILTER (prediction=1),
             count(*) FILTER (label=1 AND prediction=1) FROM v3) k"""
_REPORT = with_v3(f"""
SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       support FROM ({_CLASSES}) c
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(hits)/sum(support), 6), sum(support)::bigint
FROM ({_CLASSES}) c
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       sum(support)::bigint FROM ({_CLASSES}) c
UNION ALL
SELECT 'weighted avg', round(sum(precision*support)/sum(support), 6),
       round(sum(recall*support)/sum(support), 6), round(sum(f1*support)/sum(support), 6),
       sum(support)::bigint FROM ({_CLASSES}) c""")

_RANKED = """
SELECT prob, p, q, sum(p) OVER (ORDER BY prob DESC) AS cp, sum(q) OVER (ORDER BY prob DESC) AS cq,
       sum(p) OVER () AS ap, sum(q) OVER () AS aq
FROM (SELECT prob, count(*) FILTER (label=1) AS p, count(*) FILTER (label=0) AS q
      FROM v3 GROUP BY 1) g"""
_ROC = with_v3(f"""
SELECT round(cq/aq, 6) AS fpr, round(cp/ap, 6) AS tpr, round(prob, 6) AS threshold
FROM ({_RANKED}) r
UNION ALL SELECT 0.0::double, 0.0::double, 'infinity'::double""")
_PR = with_v3(f"""
SELECT round(cp/(cp+cq), 6) AS precision, round(cp/ap, 6) AS recall, round(prob, 6) AS threshold
FROM ({_RANKED}) r
UNION ALL SELECT 1.0::double, 0.0::double, NULL""")
_AUC = with_v3(f"SELECT round(sum(q*(cp-p+p/2))/(max(ap)*max(aq)), 6) AS auc FROM ({_RANKED}) r")
_CONFUSION = with_v3("""
SELECT 0 AS actual, count(*) FILTER (prediction=0) AS predicted_0,
       count(*) FILTER (prediction=1) AS predicted_1 FROM v3 WHERE label=0
UNION ALL
SELECT 1, count(*) FILTER (prediction=0), count(*) FILTER (prediction=1) FROM v3 WHERE label=1""")
_COMPARE = with_v3(" UNION ALL ".join(
    f"SELECT {t}::double AS threshold, m.* FROM ({_metrics(t)}) m" for t in ("0.5", "0.38")
))
_ERRORS = with_v3(
    "SELECT count(*) FILTER (label=0 AND prediction=1) AS false_positives, "
    "count(*) FILTER (label=1 AND prediction=0) AS false_negatives FROM v3"
)
_SAMPLES = with_v3("""
SELECT * FROM (SELECT *, 'false_positive' AS error FROM v3 WHERE label=0 AND prediction=1
               ORDER BY md5(concat('42:',id)) LIMIT 5)
UNION ALL
SELECT * FROM (SELECT *, 'false_negative' AS error FROM v3 WHERE label=1 AND prediction=0
               ORDER BY md5(concat('42:',id)) LIMIT 5)""")

ORACLES = {
    "confusion_matrix": _CONFUSION,
    "classification_report": _REPORT,
    "binary_metrics": with_v3(_metrics("0.5")),
    "binary_metrics_net": with_v3(_metrics("0.35")),
    "weighted_metrics": with_v3(
        "SELECT round(sum(hits)/sum(support), 6) AS accuracy, "
        f"round(sum(f1*support)/sum(support), 6) AS weighted_f1 FROM ({_CLASSES}) c"
    ),
    "threshold_counts": with_v3(
        f"SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn FROM ({_grid(_HUNDREDTHS)}) g"
    ),
    "compare_thresholds": _COMPARE,
    "sweep_f1": _best(_HUNDREDTHS),
    "sweep_f1_twentieths": _best(_TWENTIETHS),
    "roc_auc": _AUC,
    "roc_curve": _ROC,
    "trapezoid_auc": _AUC,
    "pr_curve": _PR,
    "error_report_confusion": _CONFUSION,
    "error_report_classes": _REPORT,
    "error_report_counts": _ERRORS,
    "error_report_samples": _SAMPLES,
    "error_report_roc_curve": _ROC,
    "error_report_roc_auc": _AUC,
    "error_report_pr_curve": _PR,
    "error_report_best_threshold": _best(_HUNDREDTHS),
    "error_report_thresholds": _COMPARE,
}
