"""Checks of projections, filters, scalar expressions, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.views import (
    FEATURES,
    activities,
    activities_with_gaps,
    rounded,
    scored,
    table,
    with_v1,
    with_v2,
    with_v3,
)
from tabstride.constants import FOREST_THRESHOLD, HALF_THRESHOLD, NET_THRESHOLD
from tabstride.functions import (
    fill_missing,
    logit,
    relu,
    sigmoid,
    standard_score,
    to_double,
)
from tabstride.operators import columns as C
from tabstride.operators import metrics as M
from tabstride.operators import splits as S
from tabstride.operators.profile import missing_counts, top_categories
from tabstride.operators.scaling import assemble, fit_scaler

BUCKET_SQL = "(('0x'||substr(md5(concat('42:',id)),1,8))::bigint)"


def drop_sparse(spark, sf):
    """``f3`` is missing in 3.4 % of rows, ``standard_value`` in 5.9 %, the relation in more."""
    rows = activities_with_gaps(spark, sf).select("id", "standard_value", "f3", "f4")
    return C.drop_sparse_columns(rows, 0.05)


def label(spark, sf, **options):
    labelled = C.label_threshold(activities(spark, sf), **options)
    return labelled.select("id", "active")


def project(spark, sf):
    rows = C.label_threshold(activities(spark, sf)).withColumn(
        "scaledFeatures", F.array(*[F.col(f) for f in FEATURES])
    )
    kept = C.project_prepared(C.filter_labelled(rows), ["id"])
    return kept.select("id", "label", *[F.col("features")[i].alias(f) for i, f in enumerate(FEATURES)])


def threshold(t):
    return lambda spark, sf: C.apply_threshold(
        scored(spark, sf).select("id", F.col("prob").alias("prob_active")), t=t
    )


def positive(spark, sf):
    rows = scored(spark, sf).withColumn("rest", 1 - F.col("prob"))
    vectors = assemble(rows, ["rest", "prob"], "probability")
    return C.positive_prob(vectors).select("id", "prob_active")


def ids(spark, sf):
    rows = activities(spark, sf).select(
        "id", "compound_id", "f1", F.lit(0.25).alias("prob_active"), F.lit(0).alias("pred_active")
    )
    return C.passthrough_ids(rows, "no_such_column")


def append(spark, sf):
    derived = F.struct(
        (F.col("f1") * (1 - F.col("f6"))).alias("net_price"), (F.col("f4") + 1).alias("next_line")
    )
    rows = activities(spark, sf).select("id", "f1", "f4", "f6")
    return rounded(C.append_columns(rows, derived), 4, "net_price")


def split(spark, sf):
    rows = activities(spark, sf).select("id")
    train, test = S.random_split(rows)
    return test.withColumn("part", F.lit("test")).unionByName(
        train.withColumn("part", F.lit("train"))
    )



def standard(spark, sf):
    rows = activities(spark, sf)
    scaler = fit_scaler(rows, ["f1"], ddof=0)
    score = standard_score("f1", scaler.means[0], scaler.stds[0])
    return rows.select("id", F.round(score, 6).alias("z"))


QUERIES = {
    "select_features": lambda spark, sf: C.select_features(activities(spark, sf), FEATURES),
    "drop_columns": lambda spark, sf: C.drop_columns(
        table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority"]
    ),
    "drop_sparse_columns": drop_sparse,
    "label_threshold": label,
    "label_threshold_inclusive": lambda spark, sf: label(
        spark, sf, c="f4", t=3, inclusive=True
    ),
    "label_threshold_text": lambda spark, sf: label(spark, sf, c="raw_value", t=25),
    "filter_labelled": lambda spark, sf: C.filter_labelled(
        C.label_threshold(activities(spark, sf))
    ).select("id", "active"),
    "filter_relation": lambda spark, sf: C.filter_relation(activities(spark, sf)).select(
        "id", "standard_relation"
    ),
    "to_numeric_coerce": lambda spark, sf: C.to_numeric_coerce(
        activities(spark, sf), "raw_value"
    ).select("id", "raw_value"),
    "project_prepared": project,
    "apply_threshold": threshold(NET_THRESHOLD),
    "apply_threshold_forest": threshold(FOREST_THRESHOLD),
    "apply_threshold_half": threshold(HALF_THRESHOLD),
    "positive_prob": positive,
    "false_positives": lambda spark, sf: M.false_positives(scored(spark, sf)),
    "false_negatives": lambda spark, sf: M.false_negatives(scored(spark, sf)),
    "error_counts": lambda spark, sf: M.error_counts(scored(spark, sf)),
    "passthrough_ids": ids,
    "is_missing": lambda spark, sf: C.is_missing(
        activities(spark, sf).select("id", "standard_value"), "standard_value"
    ),
    "missing_counts": lambda spark, sf: missing_counts(activities(spark, sf), "standard_value"),
    "head": lambda spark, sf: C.head(table(spark, sf, "orders"), ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    ),
    "append_columns": append,
    "top_categories": lambda spark, sf: top_categories(activities(spark, sf), "compound_id", 10),
    "sample_errors": lambda spark, sf: S.sample_errors(scored(spark, sf)),
    "random_split": split,
    "stratified_split": lambda spark, sf: S.stratified_split(
        scored(spark, sf).select("id", "label")
    ),
    "kfold": lambda spark, sf: S.kfold(activities(spark, sf).select("id")),
    "sigmoid": lambda spark, sf: activities(spark, sf).select(
        "id", F.round(sigmoid(F.col("f7") / 1000), 6).alias("y")
    ),
    "logit": lambda spark, sf: activities(spark, sf).select(
        "id", F.round(logit((F.col("f6") + 0.5)), 6).alias("y")
    ),
    "relu": lambda spark, sf: activities(spark, sf).select("id", relu("f7").alias("y")),
    "fill_missing": lambda spark, sf: activities_with_gaps(spark, sf).select(
        "id", fill_missing("f3", -1.0).alias("f3")
    ),
    "casts": lambda spark, sf: activities(spark, sf).select(
        "id",
        (F.col("f6") >= 0.05).cast("int").alias("flag"),
        F.col("f4").cast("int").alias("line"),
        to_double("raw_value").alias("number"),
    ),
    "standard_score": standard,
}

_FEATS = ", ".join(FEATURES)


def _threshold_sql(t: float) -> str:
    return with_v3(
        f"SELECT id, prob AS prob_active, CASE WHEN prob >= {t} THEN 1 ELSE 0 END AS pred_active "
        "FROM v3"
    )


ORACLES = {
    "select_features": with_v1(f"SELECT {_FEATS} FROM v1"),
    "drop_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "drop_sparse_columns": with_v2("SELECT id, f3, f4 FROM v2"),
    "label_threshold": with_v1(
        "SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS active FROM v1"
    ),
    "label_threshold_inclusive": with_v1(
        "SELECT id, CASE WHEN f4 <= 3 THEN 1 ELSE 0 END AS active FROM v1"
    ),
    "label_threshold_text": with_v1(
        "SELECT id, CASE WHEN try_cast(raw_value AS double) < 25 THEN 1 ELSE 0 END AS active FROM v1"
    ),
    "filter_labelled": with_v1(
        "SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS active FROM v1"
    ),
    "filter_relation": with_v1(
        "SELECT id, standard_relation FROM v1 WHERE standard_relation = '='"
    ),
    "to_numeric_coerce": with_v1("SELECT id, try_cast(raw_value AS double) AS raw_value FROM v1"),
    "project_prepared": with_v1(
        f"SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS label, {_FEATS} FROM v1"
    ),
    "apply_threshold": _threshold_sql(0.35),
    "apply_threshold_forest": _threshold_sql(0.38),
    "apply_threshold_half": _threshold_sql(0.5),
    "positive_prob": with_v3("SELECT id, prob AS prob_active FROM v3"),
    "false_positives": with_v3("SELECT * FROM v3 WHERE label=0 AND prediction=1"),
    "false_negatives": with_v3("SELECT * FROM v3 WHERE label=1 AND prediction=0"),
    "error_counts": with_v3(
        "SELECT count(*) FILTER (label=0 AND prediction=1) AS false_positives, "
        "count(*) FILTER (label=1 AND prediction=0) AS false_negatives FROM v3"
    ),
    "passthrough_ids": with_v1(
        "SELECT compound_id, id, 0.25::double AS prob_active, 0 AS pred_active FROM v1"
    ),
    "is_missing": with_v1(
        "SELECT id, standard_value, standard_value IS NULL AS is_missing FROM v1"
    ),
    "missing_counts": with_v1(
        "SELECT standard_value IS NULL AS is_missing, count(*) AS n FROM v1 GROUP BY 1"
    ),
    "head": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "append_columns": with_v1(
        "SELECT id, f1, f4, f6, round(f1*(1-f6), 4) AS net_price, f4+1 AS next_line FROM v1"
    ),
    "top_categories": with_v1(
        "SELECT compound_id, count(*) AS n FROM v1 GROUP BY 1 ORDER BY n DESC, compound_id LIMIT 10"
    ),
    "sample_errors": with_v3("""
SELECT * FROM (SELECT *, 'false_positive' AS error FROM v3 WHERE label=0 AND prediction=1
               ORDER BY md5(concat('42:',id)) LIMIT 5)
UNION ALL
SELECT * FROM (SELECT *, 'false_negative' AS error FROM v3 WHERE label=1 AND prediction=0
               ORDER BY md5(concat('42:',id)) LIMIT 5)"""),
    "random_split": with_v1(
        f"SELECT id, CASE WHEN {BUCKET_SQL} % 10000 >= 8000 THEN 'test' ELSE 'train' END AS part "
        "FROM v1"
    ),
    "stratified_split": with_v3("""
SELECT id, label, r*5 <= n AS is_test FROM (
  SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42:',id))) AS r,
         count(*) OVER (PARTITION BY label) AS n FROM v3) w"""),
    "kfold": with_v1(f"SELECT id, ({BUCKET_SQL} % 3)::int AS fold FROM v1"),
    "sigmoid": with_v1("SELECT id, round(1/(1+exp(-f7/1000)), 6) AS y FROM v1"),
    "logit": with_v1("SELECT id, round(ln((f6+0.5)/(1-(f6+0.5))), 6) + 0.0::double AS y FROM v1"),
    "relu": with_v1("SELECT id, greatest(f7, 0.0::double) AS y FROM v1"),
    "fill_missing": with_v2("SELECT id, coalesce(f3, -1.0::double) AS f3 FROM v2"),
    "casts": with_v1(
        "SELECT id, (f6 >= 0.05)::int AS flag, f4::int AS line, "
        "try_cast(raw_value AS double) AS number FROM v1"
    ),
    "standard_score": with_v1(
        "SELECT id, round((f1-m)/s, 6) + 0.0::double AS z FROM v1 "
        "CROSS JOIN (SELECT avg(f1) AS m, stddev_pop(f1) AS s FROM v1) t"
    ),
}
