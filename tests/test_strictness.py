"""Bad input is an error or has a stated result; no row is lost without a sign."""

import numpy as np
import pytest

from tabstride.functions import relu
from tabstride.operators import metrics as M
from tabstride.operators import profile as P
from tabstride.operators.columns import apply_threshold
from tabstride.operators.net import NetWeights, epoch_loss
from tabstride.operators.running import running_totals
from tabstride.operators.scaling import FittedScaler
from tabstride.operators.splits import kfold, random_split, stratified_split
from tabstride.plans import score_batch
from tabstride.session import broadcast_if_small
from tabstride.sources.pages import ingest_pages
from tabstride.sources.tables import scan_csv


def _pages(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "offset bigint, body string")


@pytest.mark.parametrize("broken", ['{"activities": [{"a": ', "", None, '{"activities": [{"a": "x"}]}'])
def test_broken_page_is_an_error(spark, broken):
    pages = _pages(spark, '{"activities": [{"a": 1}]}', broken, '{"activities": [{"a": 2}]}')
    with pytest.raises(Exception, match="(?i)json|malformed"):
        ingest_pages(pages, "a bigint").collect()


def test_valid_page_without_records_ends_the_ingest(spark):
    for end in ('{"activities": []}', '{"x": []}', '{"activities": null}'):
        pages = _pages(spark, '{"activities": [{"a": 1}]}', end, '{"activities": [{"a": 2}]}')
        assert [tuple(r) for r in ingest_pages(pages, "a bigint").collect()] == [(1,)]


@pytest.mark.parametrize("body", ['{"activities": []}', '{"x": []}'])
def test_source_without_records_and_schema_is_empty(spark, body):
    assert ingest_pages(_pages(spark, body)).count() == 0


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    path = str(tmp_path / "x.csv")
    assert scan_csv(spark, path, "a bigint, b bigint").first().asDict() == {"a": 2, "b": 1}
    with pytest.raises(ValueError, match="header"):
        scan_csv(spark, path, "a bigint, c bigint")


def test_null_key_is_an_error_in_every_split(spark):
    df = spark.createDataFrame([("a", 1), (None, 0)], "id string, label int")
    for split in (lambda: random_split(df)[0], lambda: kfold(df), lambda: stratified_split(df)):
        with pytest.raises(Exception, match="null row key"):
            split().collect()


@pytest.mark.parametrize("row", [(None, 0.4, 1), (2, 0.4, 1), (1, 0.4, None), (1, 0.4, 2)])
def test_other_classes_are_an_error(spark, row):
    df = spark.createDataFrame([(1, 0.9, 1), row], "label int, prob double, prediction int")
    uses = [M.confusion_matrix, M.classification_report]
    if row[0] != 1:
        uses += [M.sweep_f1, M.roc_auc, M.roc_curve]
    for use in uses:
        with pytest.raises(Exception, match="class other than"):
            use(df).collect()


def test_scaler_and_net_must_fit_the_features(spark):
    df = spark.createDataFrame([(1, 3.0, 10.0)], "id int, x double, y double")
    net = NetWeights(((np.array([[1.0, 0.0]]), np.array([0.0])),))
    swapped = FittedScaler(("y", "x"), (10.0, 1.0), (5.0, 2.0))
    got = score_batch(df, ["x", "y"], swapped, net, id_col="id").first()
    assert got["prob_active"] == pytest.approx(1 / (1 + np.exp(-1.0)))
    with pytest.raises(ValueError, match="Scaler"):
        score_batch(df, ["x", "y"], FittedScaler(("x",), (1.0,), (2.0,)), net)
    with pytest.raises(ValueError, match="inputs"):
        score_batch(df, ["x"], FittedScaler(("x",), (1.0,), (2.0,)), net)


def test_missing_scores_and_values(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.9,)], "prob_active double")
    assert [r["pred_active"] for r in apply_threshold(df).collect()] == [0, 0, 1]
    assert df.select(relu("prob_active").alias("x")).collect()[1]["x"] is None
    net = NetWeights(((np.array([[1.0]]), np.array([0.0])),))
    rows = spark.createDataFrame([(1.0, 1), (None, 0)], "x double, label int")
    with pytest.raises(Exception, match="missing value"):
        epoch_loss(rows, ["x"], net).collect()


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "`a.b` double")
    assert P.null_counts(df).first()["n_missing"] == 1
    assert P.describe_numeric(df, ["a.b"]).first()["count"] == 1


def test_automatic_histogram_of_a_long_tail(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id = 0 THEN 1e9 ELSE id / 1000 END AS x")
    assert P.histogram(df, "x").agg({"n": "sum"}).first()[0] == 1000


def test_one_range_or_many(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o", "id AS v")
    for size in (1_000_000, 100):
        total = running_totals(df, [df["o"].asc()], ["v"], ["k"], size)
        assert total.filter("o = 999").first()["cum_v"] == sum(range(0, 1000, 3))


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(100).selectExpr("repeat('x', 1000) AS s", "sequence(0, 50) AS a")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(wide))
    assert not hinted(broadcast_if_small(wide, max_bytes=50_000))
