"""Featurise, score and artefact cases on small hand-made frames."""

import math
import sys
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow.compute as pc
import pytest
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabstride.constants import DEFAULT_FEATURES as FEATURES
from tabstride.constants import NET_LAYERS
from tabstride.functions import TEXT_DESCRIPTORS, text_descriptors
from tabstride.operators.columns import (
    drop_columns,
    drop_sparse_columns,
    id_columns,
    label_threshold,
    select_features,
)
from tabstride.operators.featurize import featurize, featurize_batches, python_kernel
from tabstride.operators.net import NetWeights, mlp_score
from tabstride.operators.scaling import FittedScaler, apply_fitted, assemble, fit_scaler, impute
from tabstride.plans import prepare, score_batch
from tabstride.sources.artefacts import (
    load_net,
    load_scaler,
    log_metrics_table,
    log_run,
    read_runs,
    resolve_features,
    save_features,
    save_net,
    save_scaler,
)
from tabstride.sources.pages import ingest_pages, scan_pages, union_pages
from tabstride.sources.tables import scan_csv, write_csv

# Python workers do not know this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def seven_numbers(text):
    """Stand-in for a chemistry kernel: rejects texts with an unknown letter."""
    if set(text) - set("CcOoNn1"):
        return None
    return {f: float(len(text) + i) for i, f in enumerate(FEATURES)}


def constant_net(prob):
    """Net that gives the same probability for every input."""
    logit = math.log(prob / (1 - prob))
    return NetWeights.from_rule(
        NET_LAYERS, w=lambda n, o, i: 0.0, b=lambda n, o: logit if n == 2 else 0.0
    )


def frame(spark, rows, seed=0, **extra):
    values = np.random.default_rng(seed).random((rows, 7)) + 1
    return spark.createDataFrame(pd.DataFrame(values, columns=FEATURES).assign(**extra))


def test_kernel_on_valid_invalid_and_null(spark):
    rows = spark.createDataFrame([("CCO", 1), ("INVALID", 2), (None, 3)], "text string, id int")
    kernel = python_kernel(seven_numbers, FEATURES)
    got = {r["id"]: r["d"] for r in rows.select("id", kernel(F.col("text")).alias("d")).collect()}
    assert got[2] is None and got[3] is None
    assert list(got[1].asDict()) == FEATURES
    assert all(isinstance(v, float) for v in got[1])


def test_batch_kernel_is_called_once_per_batch(spark):
    rows = spark.createDataFrame(
        [(i, None if i % 7 == 0 else "a" * (i % 5)) for i in range(1000)], "id int, text string")
    calls = spark.sparkContext.accumulator(0)

    def lengths(texts):
        calls.add(1)
        size = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        return {"twice": 2 * size, "size": size}, size > 0

    got = featurize_batches(rows.repartition(3), "text", lengths, ["size", "twice"])
    assert got.dtypes == [*rows.dtypes, ("size", "double"), ("twice", "double")]
    expected = {(i, "a" * (i % 5), float(i % 5), 2.0 * (i % 5))
                for i in range(1000) if i % 7 and i % 5}
    assert {tuple(r) for r in got.collect()} == expected and calls.value == 3
    assert got.filter("id < 0").count() == 0
    assert featurize_batches(rows.limit(0), "text", lengths, ["size", "twice"]).count() == 0
    # Without a mask every row stays; a field of another length or name is an error.
    whole = featurize_batches(rows, "text", lambda t: ({"one": np.ones(len(t))}, None), ["one"])
    assert whole.count() == rows.filter("text IS NOT NULL").count()
    with pytest.raises(ValueError, match="text"):
        featurize_batches(rows, "text", lengths, ["text"])
    for wrong in ({"one": np.ones(1)}, {"two": np.ones(1)}):
        with pytest.raises(PySparkException):
            featurize_batches(rows, "text", lambda t: (wrong, None), ["one"]).collect()


def test_featurize_csv_drops_invalid_rows(spark, tmp_path):
    source = tmp_path / "raw.csv"
    source.write_text('canonical_smiles,id\nCCO,1\nc1ccccc1,2\nINVALID,3\n"",4\n')
    rows = scan_csv(spark, str(source))
    assert dict(rows.dtypes) == {"canonical_smiles": "string", "id": "bigint"}
    out = featurize(rows, "canonical_smiles", python_kernel(seven_numbers, FEATURES)).toPandas()
    assert sorted(out["id"]) == [1, 2]
    assert out[FEATURES].notna().all().all()
    assert all(pd.api.types.is_numeric_dtype(out[f]) for f in FEATURES)


def test_featurize_keeps_schema_without_valid_rows(spark):
    rows = spark.createDataFrame([("xyz",), (None,)], "text string")
    out = featurize(rows, "text", python_kernel(seven_numbers, FEATURES))
    assert out.columns == ["text", *FEATURES]
    assert out.count() == 0


def test_text_descriptors(spark):
    rows = spark.createDataFrame([("Ab 1,\n c9",), ("",), (None,)], "text string")
    got = [r["d"] for r in rows.select(text_descriptors("text").alias("d")).collect()]
    assert list(got[0]) == [9, 3, 2, 2, 1, 1, pytest.approx(6 / 3)]
    assert got[1].asDict() == {**dict.fromkeys(TEXT_DESCRIPTORS, 0), "n_lines": 1}
    assert got[2] is None


def test_write_csv_makes_folder_and_keeps_columns(spark, tmp_path):
    path = str(tmp_path / "data" / "featurized.csv")
    rows = frame(spark, 1).withColumn("canonical_smiles", F.lit('C"C,O'))
    write_csv(rows, path)
    back = scan_csv(spark, path)
    assert back.columns == rows.columns
    assert back.first() == rows.first()


def test_csv_null_tokens_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c,d\n1,NA,x,true\nNaN,2.5,null,False\n3,n/a,y,\n")
    rows = scan_csv(spark, str(path))
    assert dict(rows.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "boolean"}
    assert [tuple(r) for r in rows.collect()] == [
        (1, None, "x", True), (None, 2.5, None, False), (3, None, "y", None)]
    with pytest.raises(PySparkException):
        scan_csv(spark, str(path), "a int, b double, c double, d boolean").collect()


def test_csv_quoted_line_break_is_never_split_silently(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"two\nlines"\n')
    assert scan_csv(spark, str(path), multi_line=True).collect()[0]["b"] == "two\nlines"
    for columns in (["a", "b"], ["b"]):
        with pytest.raises(Py4JJavaError, match="Malformed"):
            scan_csv(spark, str(path), "a string, b string").select(*columns).collect()


def test_score_batch_happy_path(spark):
    rows = frame(spark, 10, chembl_id=[f"CHEMBL{i}" for i in range(10)])
    scaler = fit_scaler(rows, FEATURES, ddof=0)
    out = score_batch(rows, FEATURES, scaler, constant_net(0.9), 0.35, "chembl_id").toPandas()
    assert list(out.columns) == ["chembl_id", "prob_active", "pred_active"]
    assert len(out) == 10 and out["pred_active"].eq(1).all()
    assert np.allclose(out["prob_active"], 0.9)


def test_threshold_effect(spark):
    rows = frame(spark, 6)
    scaler = fit_scaler(rows, FEATURES, ddof=0)
    high = score_batch(rows, FEATURES, scaler, constant_net(0.4), 0.5).toPandas()
    low = score_batch(rows, FEATURES, scaler, constant_net(0.4), 0.35).toPandas()
    assert high["pred_active"].eq(0).all() and low["pred_active"].eq(1).all()
    assert list(high.columns) == ["prob_active", "pred_active"]


def test_missing_feature_is_an_error(spark):
    scaler = fit_scaler(frame(spark, 8), FEATURES, ddof=0)
    with pytest.raises(ValueError, match=r"Missing required feature columns: \['TPSA'\]"):
        score_batch(frame(spark, 5).drop("TPSA"), FEATURES, scaler, constant_net(0.9))


def test_missing_values_are_imputed_and_rows_kept(spark):
    clean = frame(spark, 8)
    scaler = fit_scaler(clean, FEATURES, ddof=0)
    gaps = clean.toPandas()
    gaps.loc[0, "MolWt"] = np.nan
    gaps.loc[3, "NumHDonors"] = np.nan
    out = score_batch(spark.createDataFrame(gaps), FEATURES, scaler, NetWeights.random())
    assert out.count() == 8
    assert out.filter("prob_active IS NULL OR isnan(prob_active)").count() == 0


@pytest.mark.parametrize("gap", [None, float("nan")])
def test_impute_uses_fitted_means(spark, gap):
    means = [10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0]
    rows = [(gap, *means[1:]), (*means[:3], gap, *means[4:])]
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in FEATURES))
    scaler = FittedScaler(tuple(FEATURES), tuple(means), (0.0,) * 7)
    out = impute(df, FEATURES, scaler).collect()
    assert [list(r) for r in out] == [means, means]
    for constant in ("zero", "one"):
        scaled = apply_fitted(impute(df, FEATURES, scaler), scaler, constant).collect()
        assert [list(r) for r in scaled] == [[0.0] * 7] * 2


def test_impute_falls_back_to_medians(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,), (7.0,), (4.0,)], "x double")
    scaler = FittedScaler(("a", "b"), (0.0, 0.0), (1.0, 1.0))
    assert sorted(r["x"] for r in impute(df, ["x"], scaler).collect()) == [1.0, 2.0, 3.0, 4.0, 7.0]


def test_constant_feature_zero_versus_centre(spark):
    rows = spark.createDataFrame([(5.0,), (6.0,)], "x double")
    fitted = FittedScaler(("x",), (5.0,), (0.0,))
    assert [r["x"] for r in apply_fitted(rows, fitted, "zero").collect()] == [0.0, 0.0]
    assert [r["x"] for r in apply_fitted(rows, fitted, "one").collect()] == [0.0, 1.0]


def test_select_features(spark):
    rows = frame(spark, 3).select(*reversed(FEATURES))
    assert select_features(rows, FEATURES).columns == FEATURES
    with pytest.raises(ValueError, match="Missing required feature columns"):
        select_features(rows.drop("LogP"), FEATURES)


def test_resolve_features(spark, tmp_path):
    path = str(tmp_path / "features")
    assert len(resolve_features(spark, path)) == 7
    save_features(spark, FEATURES[:3], path)
    assert resolve_features(spark, path) == FEATURES[:3]
    assert resolve_features(spark, {"features": ("a", "b")}) == ["a", "b"]
    assert resolve_features(spark, ("a",)) == ["a"]
    for bad in ({"names": ["a"]}, 7):
        with pytest.raises(ValueError, match="Invalid features artifact"):
            resolve_features(spark, bad)


def test_net_gives_one_output_per_row(spark, tmp_path):
    rows = spark.createDataFrame([(0.0,) * 7] * 4, ", ".join(f"{f} double" for f in FEATURES))
    net = NetWeights.random()
    path = str(tmp_path / "net")
    save_net(spark, net, path)
    out = mlp_score(rows, FEATURES, load_net(spark, path)).toPandas()["prob_active"]
    x = np.zeros(7)
    for n, (w, b) in enumerate(net.layers):
        x = w @ x + b if n == 2 else np.maximum(w @ x + b, 0)
    assert np.allclose(out, [1 / (1 + np.exp(-x[0]))] * 4)


def test_scaler_survives_saving(spark, tmp_path):
    scaler = fit_scaler(frame(spark, 9), FEATURES, ddof=0)
    save_scaler(spark, scaler, str(tmp_path / "s"))
    assert load_scaler(spark, str(tmp_path / "s")) == scaler


def test_id_columns(spark):
    rows = spark.createDataFrame([(1, 2, 3)], "id int, compound_id int, other int")
    assert id_columns(rows) == ["compound_id", "id"]
    assert id_columns(rows, "other") == ["other"]
    assert id_columns(rows, "absent") == ["compound_id", "id"]
    assert id_columns(rows.select("other")) == []


def test_log_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    log_run(spark, path, "a", {"numTrees": 10}, {"auc": 0.5})
    log_run(spark, path, "b", metrics={"auc": 0.75})
    assert {tuple(r) for r in read_runs(spark, path).collect()} == {
        ("a", "param", "numTrees", "10"), ("a", "metric", "auc", "0.5"),
        ("b", "metric", "auc", "0.75")}


def test_log_run_again_side_by_side_and_broken_off(spark, tmp_path):
    path = str(tmp_path / "runs")
    log_run(spark, path, "a", {"numTrees": 10, "maxDepth": 3}, {"auc": 0.5})
    log_run(spark, path, "a", {"numTrees": 20}, {"auc": 0.75})
    table = spark.range(1).select(F.lit(0.25).alias("recall"), F.lit(1.0).alias("precision"))
    for _ in range(2):
        log_metrics_table(table, path, "a")
    with ThreadPool(4) as pool:
        pool.map(lambda i: log_run(spark, path, f"p{i % 2}", {"i": i, "j": i}), range(6))
    log_run(spark, path, "none")
    # A call of which only a part arrived: two of its three rows.
    whole = str(tmp_path / "whole")
    log_run(spark, whole, "a", {"numTrees": 30, "maxDepth": 9}, {"auc": 1.0})
    written = spark.read.option("recursiveFileLookup", True).parquet(whole)
    written.limit(2).write.parquet(f"{path}/broken")

    runs = [tuple(r) for r in read_runs(spark, path).collect()]
    assert {r for r in runs if r[0] == "a"} == {
        ("a", "param", "numTrees", "20"), ("a", "metric", "auc", "0.75"),
        ("a", "metric", "recall", "0.25"), ("a", "metric", "precision", "1.0")}
    assert len(runs) == len(set(runs)) == 8
    for run in ("p0", "p1"):
        values = {r[3] for r in runs if r[0] == run}
        assert len(values) == 1 and int(values.pop()) % 2 == int(run[1])


def test_label_rules(spark):
    rows = spark.createDataFrame(
        [("999.9",), ("1000",), ("1e2",), ("bad",), (None,), ("NaN",)], "standard_value string")
    assert [r["active"] for r in label_threshold(rows).collect()] == [1, 0, 1, 0, 0, 0]
    assert [r["active"] for r in label_threshold(rows, inclusive=True).collect()] == [
        1, 1, 1, 0, 0, 0]


def test_invalid_features_in_prepare(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 5.0), ("b", None, 6.0), ("c", 3.0, 7.0)],
        "id string, x double, standard_value double")
    with pytest.raises(Py4JJavaError, match="Encountered null"):
        prepare(rows, feats=["x"]).collect()
    assert prepare(rows, feats=["x"], handle_invalid="skip").count() == 2
    assert assemble(rows, ["x"], handle_invalid="keep").count() == 3


def test_drop_columns(spark):
    rows = spark.createDataFrame([(1, None, 2.0), (2, None, float("nan"))], "a int, b int, c double")
    assert drop_columns(rows, ["b"]).columns == ["a", "c"]
    with pytest.raises(ValueError):
        drop_columns(rows, ["z"])
    assert drop_sparse_columns(rows, 0.5).columns == ["a", "c"]
    assert drop_sparse_columns(rows, 0.4).columns == ["a"]


def test_page_files_stop_at_first_page_without_records(spark, tmp_path):
    pages = {
        0: '{"activities":[{"id":1,"v":0.5},{"id":2}]}',
        1000: '{"activities":[{"id":3,"note":"x"}]}',
        2000: '{"page_meta":{}}',
        3000: '{"activities":[{"id":4}]}',
    }
    for offset, body in pages.items():
        (tmp_path / f"page-{offset}.json").write_text(body)
    rows = ingest_pages(scan_pages(spark, str(tmp_path))).select("id", "v", "note")
    assert sorted(map(tuple, rows.collect())) == [(1, 0.5, None), (2, None, None), (3, None, "x")]


def test_pages_without_end_and_empty_first_page(spark):
    schema = "id bigint"
    whole = spark.createDataFrame(
        [(0, '{"activities":[{"id":1}]}'), (5, '{"activities":[{"id":2}]}')],
        "offset bigint, body string")
    assert sorted(r["id"] for r in ingest_pages(whole, schema).collect()) == [1, 2]
    none = spark.createDataFrame([(0, '{"activities":[]}')], "offset bigint, body string")
    assert ingest_pages(none, schema).count() == 0


def test_union_pages_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    out = union_pages([a, b, a])
    assert out.columns == ["id", "a", "b"] and out.count() == 3
