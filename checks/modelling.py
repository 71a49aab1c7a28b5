"""Checks of featurisation, fitted statistics, models and flows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.sources import PREPARED_SQL
from checks.views import (
    FEATURES,
    NET,
    NET_INPUT_SQL,
    activities,
    activities_with_gaps,
    documents,
    net_inputs,
    net_logit_sql,
    rounded,
    table,
    with_v1,
    with_v2,
)
from tabstride.constants import FOREST_GRID
from tabstride.functions import TEXT_DESCRIPTORS, text_descriptors
from tabstride.operators import forest as RF
from tabstride.operators import net as N
from tabstride.operators.columns import positive_prob
from tabstride.operators.featurize import featurize, featurize_batches, python_kernel
from tabstride.operators.scaling import (
    apply_fitted,
    assemble,
    fit_scaler,
    impute,
    scaler_stats,
)
from tabstride.operators.splits import label_sample, random_split
from tabstride.plans import (
    evaluate,
    evaluate_run,
    prepare,
    prepare_columns,
    saved_error_report,
    score_batch,
    train_net,
)
from tabstride.session import scratch_path, stored
from tabstride.sources.artefacts import (
    load_forest,
    load_net,
    read_runs,
    resolve_features,
    save_features,
    save_forest,
    save_net,
)

# Labelled rows that mlp_fit and evaluate_search fit on at most; all other fits take all train
# rows, and scoring always covers all rows.
MOST_FITTED = 2_000
MOST_SEARCHED = 200


def featurized(spark, sf):
    rows = featurize(documents(spark, sf), "text", text_descriptors).drop("text")
    return rounded(rows)


def word_numbers(text: str) -> dict[str, float] | None:
    """A Python kernel: counts of the vowels; a text without any is invalid."""
    counts = {f"n_{v}": text.count(v) for v in "aeiou"}
    return counts if sum(counts.values()) else None


def featurized_python(spark, sf):
    kernel = python_kernel(word_numbers, [f"n_{v}" for v in "aeiou"])
    return featurize(documents(spark, sf), "text", kernel).drop("text")


def word_columns(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The same counts for a whole Arrow batch."""
    counts = {f"n_{v}": pc.count_substring(texts, v).to_numpy() for v in "aeiou"}
    return counts, sum(counts.values()) > 0


def featurized_batches(spark, sf):
    rows = featurize_batches(
        documents(spark, sf), "text", word_columns, [f"n_{v}" for v in "aeiou"])
    return rows.drop("text")


def labelled_documents(spark, sf):
    """Descriptors of all documents, with the quality of the labelled ones, -1 for the rest."""
    texts = table(spark, sf, "documents").select("doc_id", "text")
    rows = featurize(texts, "text", text_descriptors)
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return rounded(rows.join(labels, "doc_id", "left").select(
        "doc_id", F.coalesce("label", F.lit(-1)).alias("label"), *TEXT_DESCRIPTORS))


def assembled(spark, sf):
    vectors = assemble(activities(spark, sf), FEATURES)
    values = vector_to_array("features")
    return vectors.select("id", *[values[i].alias(f) for i, f in enumerate(FEATURES)])


def assembled_skip(spark, sf):
    vectors = assemble(activities_with_gaps(spark, sf), FEATURES, handle_invalid="skip")
    values = vector_to_array("features")
    return vectors.select("id", *[values[i].alias(f) for i, f in enumerate(FEATURES)])


def scaler(ddof):
    return lambda spark, sf: rounded(
        scaler_stats(activities_with_gaps(spark, sf), FEATURES, ddof), 4
    )


def train_scaler(spark, sf):
    train, _ = random_split(activities(spark, sf))
    return rounded(scaler_stats(train, FEATURES, 0), 4)


def scale(constant):
    def run(spark, sf):
        rows = activities(spark, sf).withColumn("same", F.lit(3.5)).select("id", "same", *FEATURES)
        names = ["same", *FEATURES]
        return rounded(apply_fitted(rows, fit_scaler(rows, names, ddof=0), constant))

    return run


def imputed(spark, sf):
    rows = activities_with_gaps(spark, sf).select("id", *FEATURES)
    return rounded(impute(rows, FEATURES, fit_scaler(rows, FEATURES)))


def imputed_median(spark, sf):
    # Medians take two reads of the rows, the result a third.
    rows = stored(activities_with_gaps(spark, sf).select("id", *FEATURES))
    return impute(rows, FEATURES)


def inputs(spark, sf):
    """The columns that a model needs, stored: fits, scores and reports read them many times."""
    return stored(activities(spark, sf).select("id", "standard_value", *FEATURES))


def prepared(spark, sf):
    """Prepared training set: id, features, label."""
    return prepare(inputs(spark, sf), feats=FEATURES)


def parts(spark, sf):
    return random_split(prepared(spark, sf))


def forest(spark, sf):
    return forest_of(prepared(spark, sf))


def forest_of(rows):
    train, test = random_split(rows)
    return RF.rf_fit(train), test


def importances(spark, sf):
    """Each feature of a fitted forest; whether its share is one, and all shares sum to one."""
    model, _ = forest(spark, sf)
    shares = model.featureImportances.toArray()
    total = bool(abs(shares.sum() - 1) < 1e-9)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(bool(0 <= v <= 1)).alias("is_share"),
                               F.lit(total).alias("sum_is_one"))
                      for f, v in zip(FEATURES, shares)])
    return spark.range(1).select(F.inline(pairs))


def predictions(spark, sf):
    """All test rows, with whether the probability is one and the class follows from it."""
    model, test = forest(spark, sf)
    scored = positive_prob(RF.predict_forest(model, test), "prob")
    return scored.select(
        "id", "label", F.col("prob").between(0, 1).alias("is_probability"),
        (F.col("prediction") == (F.col("prob") > 0.5).cast("int")).alias("class_follows"))


def reloaded(spark, sf):
    """Rows on which a saved and reloaded forest gives another probability: none."""
    model, test = forest(spark, sf)
    path = scratch_path(spark, "forest")
    save_forest(model, path)
    before = positive_prob(model.transform(test), "before").select("id", "features", "before")
    after = positive_prob(load_forest(path).transform(before), "after")
    return after.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("before") != F.col("after")).alias("n_changed"),
    )


def saved_analysis(spark, sf):
    """Error analysis of a saved forest: class sizes, and whether its tables agree."""
    rows = prepared(spark, sf)
    model, _ = forest_of(rows)
    path = scratch_path(spark, "forest")
    save_forest(model, path)
    tables = saved_error_report(path, rows)
    cells = {r["actual"]: r for r in tables["confusion_matrix"].collect()}
    errors = tables["error_counts"].first()
    area = tables["roc_auc"].first()["auc"]
    agree = (errors["false_positives"] == cells[0]["predicted_1"]
             and errors["false_negatives"] == cells[1]["predicted_0"] and 0 <= area <= 1)
    return tables["confusion_matrix"].select(
        "actual", (F.col("predicted_0") + F.col("predicted_1")).alias("n_rows"),
        F.lit(agree).alias("tables_agree"))


def searched_run(spark, sf):
    """A small search run as a whole: all test rows, and whether its best setting is logged."""
    train, test = parts(spark, sf)
    model = RF.rf_cross_validate(
        label_sample(train, MOST_SEARCHED), {"numTrees": [5, 10], "maxDepth": [2, 4]},
        partitions=1, parallelism=8)
    path = scratch_path(spark, "searched")
    rows = evaluate_run(model, test, path, "search")
    logged = {r["key"]: float(r["value"]) for r in read_runs(spark, f"{path}/runs").collect()
              if r["key"] in ("numTrees", "maxDepth")}
    top = _settings(model)[int(np.argmax(model.avgMetrics))][0]
    kept = load_forest(f"{path}/model").getNumTrees == logged["numTrees"]
    follows = F.col("custom_prediction") == (F.col("prob") >= 0.38).cast("int")
    return rows.select("id", "label", follows.alias("decided"),
                       F.lit(logged == top).alias("best_logged"), F.lit(kept).alias("best_kept"))


def search(spark, sf):
    train, _ = parts(spark, sf)
    return RF.rf_cross_validate(train, parallelism=8)


def _settings(model):
    return [
        ({p.name: float(v) for p, v in setting.items()}, area)
        for setting, area in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]


def cross_validated(spark, sf):
    """Every setting of the grid, and whether its mean ROC area is one."""
    cells = [
        F.struct(*[F.lit(values[n]).alias(n) for n in RF.SEARCHED],
                 F.lit(bool(0 <= area <= 1)).alias("is_area"))
        for values, area in _settings(search(spark, sf))
    ]
    return spark.range(1).select(F.inline(F.array(*cells)))


def best(spark, sf):
    """Whether the best setting is one of the grid and has the largest area."""
    model = search(spark, sf)
    chosen = {n: float(v) for n, v in RF.best_params(model).items()}
    settings = _settings(model)
    areas = [area for values, area in settings if values == chosen]
    top = max(area for _, area in settings)
    return spark.range(1).select(
        F.lit(len(settings)).alias("n_settings"), F.lit(len(areas)).alias("n_same"),
        F.lit(areas == [top]).alias("is_best"))


def evaluated(spark, sf):
    """Logged numbers of an evaluation against plain SQL over its stored predictions."""
    model, test = forest(spark, sf)
    path = scratch_path(spark, "evaluation")
    rows = evaluate_run(model, test, path, "forest")
    logged = {r["key"]: float(r["value"]) for r in read_runs(spark, f"{path}/runs").collect()}
    one_row = evaluate(model, test).first()
    truth = spark.sql("""
      WITH s AS (SELECT label, prob, custom_prediction AS p FROM {rows}),
      c AS (SELECT count(*) AS n, count_if(p=label) AS hit, count_if(p=1 AND label=1) AS tp,
                   count_if(p=0 AND label=0) AS tn, count_if(label=1) AS pos,
                   count_if(label=0) AS neg, count_if(p=1) AS called FROM s),
      g AS (SELECT prob, count_if(label=1) AS gp, count_if(label=0) AS gn FROM s GROUP BY prob),
      a AS (SELECT sum(gn * (above + gp / 2)) AS wins FROM (SELECT gn, gp, coalesce(sum(gp) OVER (
              ORDER BY prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
              FROM g))
      SELECT hit / n AS accuracy, wins / (pos * neg) AS auc,
             (pos * 2 * tp / (called + pos) + neg * 2 * tn / (n - called + neg)) / n AS weighted_f1,
             n FROM c CROSS JOIN a""", rows=rows).first()
    same = lambda k: abs(logged[k] - truth[k]) < 1e-9 and abs(one_row[k] - truth[k]) < 1e-9
    return spark.range(1).select(
        F.lit(truth["n"]).cast("bigint").alias("n_rows"), F.lit(logged["decision_threshold"]).alias("threshold"),
        *[F.lit(same(k)).alias(f"{k}_agrees") for k in ("accuracy", "weighted_f1", "auc")])


def net_training(spark, sf):
    train, _ = random_split(inputs(spark, sf))
    columns, _ = prepare_columns(train, feats=FEATURES)
    return columns


def net_losses(spark, sf):
    """Epochs of a full training, and whether the loss fell."""
    rows = label_sample(net_training(spark, sf), MOST_FITTED)
    _, losses = N.mlp_fit(rows, FEATURES, "active", lanes=4)
    return spark.range(1).select(
        F.lit(len(losses)).alias("n_epochs"), F.lit(losses[-1] < losses[0]).alias("loss_fell"))


def net_flow(spark, sf):
    """Net training flow: all test rows, whether decided at the threshold, whether logged right."""
    rows = stored(activities(spark, sf).select(
        "id", F.when(F.col("standard_value") < 1000, 1).otherwise(0).alias("label"), *FEATURES))
    path = scratch_path(spark, "net_run")
    predicted = train_net(rows, path, "net", FEATURES)
    logged = {r["key"]: float(r["value"]) for r in read_runs(spark, f"{path}/runs").collect()}
    c = predicted.selectExpr(
        "count(*) AS n", "count_if(prediction = label) AS hit", "count_if(prediction = 1) AS called",
        "count_if(label = 1) AS pos", "count_if(prediction = 1 AND label = 1) AS tp").first()
    right = (abs(logged["accuracy"] - c["hit"] / c["n"]) < 1e-9
             and abs(logged["recall"] - c["tp"] / max(c["pos"], 1)) < 1e-9
             and abs(logged["precision"] - c["tp"] / max(c["called"], 1)) < 1e-9)
    return predicted.select(
        "id", "label", (F.col("prediction") == (F.col("prob") >= 0.35).cast("int")).alias("decided"),
        F.lit(right).alias("logged_right"))


def resolved_features(spark, sf):
    """The columns that a saved list of features names."""
    path = scratch_path(spark, "features")
    save_features(spark, FEATURES[::-1], path)
    return activities(spark, sf).select("id", *resolve_features(spark, path))


def perceptron(spark, sf):
    train, test = parts(spark, sf)
    model = N.perceptron_fit(train)
    scored = positive_prob(model.transform(test), "prob")
    return scored.select("id", "label", F.col("prob").between(0, 1).alias("is_probability"))


def net_scored(spark, sf):
    return rounded(N.mlp_score(net_inputs(activities(spark, sf)), FEATURES, NET).select(
        "id", "prob_active"))


def net_reloaded(spark, sf):
    path = scratch_path(spark, "net")
    save_net(spark, NET, path)
    rows = N.mlp_score(net_inputs(activities(spark, sf)), FEATURES, load_net(spark, path))
    return rounded(rows.select("id", "prob_active"))


def loss(spark, sf):
    return rounded(N.epoch_loss(net_inputs(activities(spark, sf)), FEATURES, NET))


def batch(spark, sf):
    """Scaler fitted on the train rows; all rows are imputed, scaled, scored and decided."""
    rows = activities_with_gaps(spark, sf)
    train, _ = random_split(rows)
    fitted = fit_scaler(train, FEATURES, ddof=0)
    return rounded(score_batch(rows, FEATURES, fitted, NET, id_col="id"))


def prepared_scalars(spark, sf):
    values = vector_to_array("features")
    return rounded(prepared(spark, sf).select(
        "id", "label", *[values[i].alias(f) for i, f in enumerate(FEATURES)]))


QUERIES = {
    "featurize": featurized,
    "featurize_python": featurized_python,
    "featurize_batches": featurized_batches,
    "text_descriptors": labelled_documents,
    "assemble": assembled,
    "assemble_skip": assembled_skip,
    "fit_scaler": scaler(1),
    "fit_scaler_population": scaler(0),
    "fit_scaler_train": train_scaler,
    "scale": scale("zero"),
    "scale_centre_constant": scale("one"),
    "apply_fitted": lambda spark, sf: rounded(prepare_columns(
        activities(spark, sf), feats=FEATURES)[0].select("id", *FEATURES)),
    "impute": imputed,
    "impute_median": imputed_median,
    "prepare": prepared_scalars,
    "rf_fit": importances,
    "rf_cross_validate": cross_validated,
    "best_params": best,
    "predict_forest": predictions,
    "save_load_model": reloaded,
    "evaluate": evaluated,
    "evaluate_search": searched_run,
    "error_analysis": saved_analysis,
    "mlp_fit": net_losses,
    "perceptron_fit": perceptron,
    "train_net": net_flow,
    "resolve_features": resolved_features,
    "epoch_loss": loss,
    "mlp_score": net_scored,
    "save_load_net": net_reloaded,
    "score_batch": batch,
}

_DESCRIBED = """
SELECT {keys}, length(text)::int AS n_chars,
       len(regexp_extract_all(text, '[^ \\t\\r\\n]+'))::int AS n_words,
       (length(text) - length(replace(text, chr(10), '')) + 1)::int AS n_lines,
       (length(text) - length(regexp_replace(text, '[0-9]', '', 'g')))::int AS n_digits,
       (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::int AS n_upper,
       (length(text) - length(regexp_replace(text, '[!-/:-@\\[-`{{-~]', '', 'g')))::int AS n_punct,
       round(coalesce(length(regexp_replace(text, '[ \\t\\r\\n]', '', 'g'))
             / nullif(len(regexp_extract_all(text, '[^ \\t\\r\\n]+')), 0), 0), 6) AS mean_word_len
"""
_FEATS = ", ".join(FEATURES)
_VOWELS = ", ".join(f"(length(text) - length(replace(text, '{v}', '')))::double AS n_{v}"
                    for v in "aeiou")
_VOWELS_SQL = (
    f"SELECT * FROM (SELECT doc_id, lang, {_VOWELS} FROM documents) k WHERE n_a+n_e+n_i+n_o+n_u > 0"
)


def _scaler_sql(spread: str, prefix, source: str, where: str = "") -> str:
    return prefix(" UNION ALL ".join(
        f"SELECT {i} AS position, '{f}' AS feature, round(avg({f}),4) AS mean, "
        f"round({spread}({f}),4) AS std FROM {source} {where}" for i, f in enumerate(FEATURES)))


def _scale_sql(same: str) -> str:
    stats = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURES)
    cols = ", ".join(f"round(({f}-m_{f})/s_{f}, 6) + 0.0::double AS {f}" for f in FEATURES)
    return with_v1(
        f"SELECT id, {same} AS same, {cols} FROM v1 CROSS JOIN (SELECT {stats} FROM v1) s"
    )


_TRAIN = "(('0x'||substr(md5(concat('42:',id)),1,8))::bigint) % 10000 < 8000"
_BATCH_STATS = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURES)
_BATCH_X = ", ".join(f"(coalesce({f}, m_{f})-m_{f})/s_{f}" for f in FEATURES)
_BATCH_INPUT = (
    f"SELECT id, [{_BATCH_X}] AS x FROM v2 "
    f"CROSS JOIN (SELECT {_BATCH_STATS} FROM v2 WHERE {_TRAIN}) s"
)
_SCORE = with_v1(
    f"SELECT id, round(1/(1+exp(-z)), 6) AS prob_active FROM ({net_logit_sql(NET_INPUT_SQL)}) s"
)

ORACLES = {
    "featurize": _DESCRIBED.format(keys="doc_id, lang")
    + "FROM documents",
    "featurize_python": _VOWELS_SQL,
    "featurize_batches": _VOWELS_SQL,
    "text_descriptors": _DESCRIBED.format(keys="doc_id, coalesce(quality, -1)::int AS label")
    + "FROM documents LEFT JOIN labels USING (doc_id)",
    "assemble": with_v1(f"SELECT id, {_FEATS} FROM v1"),
    "assemble_skip": with_v2(f"SELECT id, {_FEATS} FROM v2 WHERE f3 IS NOT NULL"),
    "fit_scaler": _scaler_sql("stddev_samp", with_v2, "v2"),
    "fit_scaler_population": _scaler_sql("stddev_pop", with_v2, "v2"),
    "fit_scaler_train": _scaler_sql("stddev_pop", with_v1, "v1", f"WHERE {_TRAIN}"),
    "scale": _scale_sql("0.0::double"),
    "scale_centre_constant": _scale_sql("0.0::double"),
    "apply_fitted": PREPARED_SQL.replace(
        "SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS label,", "SELECT id,"
    ),
    "impute": with_v2(
        "SELECT id, f1, f2, round(coalesce(f3, m), 6) AS f3, f4, f5, f6, f7 FROM v2 "
        "CROSS JOIN (SELECT avg(f3) AS m FROM v2) s"
    ),
    "impute_median": with_v2(
        "SELECT id, f1, f2, coalesce(f3, m) AS f3, f4, f5, f6, f7 FROM v2 "
        "CROSS JOIN (SELECT quantile_cont(f3, 0.5) AS m FROM v2) s"
    ),
    "prepare": PREPARED_SQL,
    "rf_fit": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, true AS is_share, true AS sum_is_one" for f in FEATURES),
    "rf_cross_validate": "SELECT *, true AS is_area FROM " + " CROSS JOIN ".join(
        f"(SELECT unnest({[float(v) for v in values]})::double AS \"{n}\") t{i}"
        for i, (n, values) in enumerate(FOREST_GRID.items())),
    "best_params": "SELECT 36 AS n_settings, 1 AS n_same, true AS is_best",
    "predict_forest": with_v1(
        "SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS label, "
        f"true AS is_probability, true AS class_follows FROM v1 WHERE NOT ({_TRAIN})"),
    "perceptron_fit": with_v1(
        "SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS label, "
        f"true AS is_probability FROM v1 WHERE NOT ({_TRAIN})"),
    "evaluate": with_v1(
        "SELECT count(*) AS n_rows, 0.38::double AS threshold, true AS accuracy_agrees, "
        f"true AS weighted_f1_agrees, true AS auc_agrees FROM v1 WHERE NOT ({_TRAIN})"),
    "evaluate_search": with_v1(
        "SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS label, true AS decided, "
        f"true AS best_logged, true AS best_kept FROM v1 WHERE NOT ({_TRAIN})"),
    "error_analysis": with_v1(
        "SELECT CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS actual, count(*) AS n_rows, "
        f"true AS tables_agree FROM v1 WHERE NOT ({_TRAIN}) GROUP BY 1"),
    "mlp_fit": "SELECT 50 AS n_epochs, true AS loss_fell",
    "train_net": with_v1(
        "SELECT id, label, true AS decided, true AS logged_right FROM (SELECT id, label, "
        "row_number() OVER (PARTITION BY label ORDER BY md5(concat('42:', id))) AS r, "
        "count(*) OVER (PARTITION BY label) AS n FROM (SELECT id, "
        "CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS label FROM v1) b) c "
        "WHERE r <= n // 5"),
    "resolve_features": with_v1(f"SELECT id, {_FEATS} FROM v1"),
    "save_load_model": with_v1(
        f"SELECT count(*) AS n_rows, 0::bigint AS n_changed FROM v1 WHERE NOT ({_TRAIN})"
    ),
    "epoch_loss": with_v1(
        "SELECT round(avg(ln(1+exp(-abs(z))) + greatest(z, 0.0::double) - z*label), 6) AS loss "
        f"FROM ({net_logit_sql(NET_INPUT_SQL)}) s"
    ),
    "mlp_score": _SCORE,
    "save_load_net": _SCORE,
    "score_batch": with_v2(
        "SELECT id, round(1/(1+exp(-z)), 6) AS prob_active, "
        "CASE WHEN 1/(1+exp(-z)) >= 0.35 THEN 1 ELSE 0 END AS pred_active "
        f"FROM ({net_logit_sql(_BATCH_INPUT)}) s"
    ),
}
