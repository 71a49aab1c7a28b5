"""Metrics, splits and order statistics against brute force on random small data."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabstride.operators import metrics as M
from tabstride.operators import profile as P
from tabstride.operators.quantiles import column_stats, median_stats
from tabstride.operators.running import running_totals
from tabstride.operators.splits import kfold, random_split, sample_errors, stratified_split
from tabstride.plans import profile_report

FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
scores = st.lists(
    st.tuples(
        st.integers(0, 1),
        st.one_of(st.sampled_from([0.0, 0.05, 0.29, 0.38, 0.5, 0.57, 1.0]), st.floats(0, 1)),
    ),
    min_size=1,
    max_size=40,
)


def scored(spark, rows, partitions=3):
    return spark.createDataFrame(
        [(int(a), float(p)) for a, p in rows], "label int, prob double"
    ).repartition(partitions)


def counts_at(rows, t):
    tp = sum(a == 1 and p >= t for a, p in rows)
    fp = sum(a == 0 and p >= t for a, p in rows)
    fn = sum(a == 1 and p < t for a, p in rows)
    return tp, fp, fn, len(rows) - tp - fp - fn


def f1_of(rows, t):
    tp, fp, fn, _ = counts_at(rows, t)
    return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0


def pair_auc(rows):
    pos = [p for a, p in rows if a == 1]
    neg = [p for a, p in rows if a == 0]
    if not pos or not neg:
        return None
    return sum((x > y) + (x == y) / 2 for x in pos for y in neg) / (len(pos) * len(neg))


@FEW
@given(scores)
def test_sweeps(spark, rows):
    df = scored(spark, rows)
    best, best_t = 0.0, 0.5
    for i in range(1, 100):
        if f1_of(rows, i / 100) > best:
            best, best_t = f1_of(rows, i / 100), i / 100
    got = M.sweep_f1(df).first()
    assert got["best_threshold"] == best_t and got["best_f1"] == pytest.approx(best)

    grid = np.linspace(0.05, 0.95, 19).tolist()
    assert grid == M.GRID_TWENTIETHS
    first = max(grid, key=lambda t: f1_of(rows, t))
    got = M.sweep_f1(df, M.GRID_TWENTIETHS, None).first()
    assert got["best_threshold"] == first
    counts = {r["threshold"]: tuple(r)[1:] for r in M.threshold_counts(df, grid).collect()}
    assert counts == {t: counts_at(rows, t) for t in grid}


@FEW
@given(scores)
def test_curves(spark, rows):
    df = scored(spark, rows)
    positives, negatives = sum(a for a, _ in rows), sum(1 - a for a, _ in rows)
    levels = sorted({p for _, p in rows}, reverse=True)
    for limit in (1_000_000, 3):
        auc = M.roc_auc(df, single_task_rows=limit).first()["auc"]
        expected = pair_auc(rows)
        assert auc is None if expected is None else auc == pytest.approx(expected)

        roc = {r["threshold"]: (r["fpr"], r["tpr"])
               for r in M.roc_curve(df, single_task_rows=limit).collect()}
        assert roc.pop(math.inf) == (0.0, 0.0)
        assert sorted(roc, reverse=True) == levels
        pr = {r["threshold"]: (r["precision"], r["recall"])
              for r in M.pr_curve(df, single_task_rows=limit).collect()}
        assert pr.pop(None) == (1.0, 0.0)
        for t in levels:
            tp, fp, _, _ = counts_at(rows, t)
            assert roc[t] == (
                pytest.approx(fp / negatives) if negatives else None,
                pytest.approx(tp / positives) if positives else None,
            )
            assert pr[t][0] == pytest.approx(tp / (tp + fp))
            assert pr[t][1] == pytest.approx(tp / positives if positives else 1.0)
    if expected is not None:
        curve = M.roc_curve(df)
        for limit in (1_000_000, 3):
            area = M.trapezoid_auc(curve, single_task_rows=limit).first()["auc"]
            assert area == pytest.approx(expected)


def test_scores_must_be_present(spark):
    for bad in (None, float("nan")):
        df = spark.createDataFrame([(1, 0.5), (0, bad)], "label int, prob double")
        with pytest.raises(PySparkException, match="missing score"):
            M.roc_auc(df).collect()


def test_many_scores_match_built_in_evaluators(spark):
    rng = np.random.default_rng(5)
    label = rng.integers(0, 2, 5000)
    prob = np.clip(rng.normal(0.4 + 0.2 * label, 0.2), 0, 1)
    # One score holds a third of all rows.
    prob[:1700] = 0.5
    df = scored(spark, zip(label, prob), 7)
    raw = df.withColumn("rawPrediction", F.col("prob"))
    area = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    for limit in (1_000_000, 200):
        assert M.roc_auc(df, single_task_rows=limit).first()["auc"] == pytest.approx(area)
    decided = df.withColumn("prediction", (F.col("prob") >= 0.38).cast("double"))
    ours = M.weighted_metrics(decided).first()
    for name, ours_name in (("accuracy", "accuracy"), ("f1", "weighted_f1")):
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(decided)
        assert ours[ours_name] == pytest.approx(theirs)


def test_undefined_metrics_are_zero(spark):
    none = spark.createDataFrame([], "label int, prob double, prediction int")
    assert tuple(M.binary_metrics(none).first()) == (0.0, 0.0, 0.0, 0.0)
    assert M.roc_auc(none).first()["auc"] is None
    assert M.sweep_f1(none).first()["best_threshold"] == 0.5
    assert [tuple(r) for r in M.confusion_matrix(none).collect()] == [(0, 0, 0), (1, 0, 0)]
    only = spark.createDataFrame([(0, 0.1, 0)] * 3, "label int, prob double, prediction int")
    report = {r["name"]: r for r in M.classification_report(only).collect()}
    assert report["1"]["precision"] == report["1"]["recall"] == report["1"]["f1"] == 0.0
    assert report["0"]["f1"] == 1.0 and report["accuracy"]["f1"] == 1.0
    assert report["macro avg"]["f1"] == 0.5 and report["weighted avg"]["f1"] == 1.0
    assert M.sweep_f1(only, M.GRID_TWENTIETHS, None).first()["best_threshold"] == 0.05


@FEW
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-5, 5).map(float),
                                                st.floats(-1e6, 1e6))),
        min_size=1, max_size=60,
    )
)
def test_column_stats(spark, rows):
    """Exact quantiles, also when ranges are split and when the brackets are of no use."""
    df = spark.createDataFrame(rows, "g int, x double").repartition(4)
    pdf = pd.DataFrame(rows, columns=["g", "x"]).dropna()
    expected = {g: v["x"].quantile([0.25, 0.5, 0.9]).tolist() for g, v in pdf.groupby("g")}
    for options in ({}, {"sketch_size": 8}, {"sketch_size": 8, "single_task_rows": 4}):
        got = column_stats(df, ["x"], [0.25, 0.5, 0.9], by=["g"], **options).collect()
        assert {r["g"]: r["quantiles"] for r in got} == {
            g: pytest.approx(q) for g, q in expected.items()}
        assert {r["g"]: r["n"] for r in got} == pdf.groupby("g").size().to_dict()


def test_column_stats_with_brackets_in_use(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=20_000), np.full(10_000, 0.25), [np.inf, -np.inf]])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": np.round(x, 1)})).repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for options in ({"sketch_size": 200}, {"sketch_size": 2000, "single_task_rows": 50}):
        got = {r["column"]: r["quantiles"] for r in
               column_stats(df, ["x", "y"], probs, **options).collect()}
        for c, values in (("x", x), ("y", np.round(x, 1))):
            assert got[c][1:4] == pytest.approx(np.quantile(values, probs[1:4]).tolist())
            assert got[c][0] == -math.inf and got[c][4] == math.inf


def test_median_of_missing_column(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 3.0)], "a double, b double")
    assert [tuple(r) for r in median_stats(df, ["a", "b"]).collect()] == [("b", 2.0)]


def test_running_totals_per_key(spark):
    pdf = pd.DataFrame({"k": np.arange(500) % 3, "v": np.arange(500), "n": 1})
    pdf.loc[pdf["v"] > 300, "k"] = 0
    pdf["cum_n"] = pdf.sort_values("v").groupby("k")["n"].cumsum()
    df = spark.createDataFrame(pdf[["k", "v", "n"]]).repartition(6)
    for limit in (1000, 40, 7):
        got = running_totals(df, [F.col("v")], ["n"], ["k"], limit).toPandas()
        assert got.sort_values("v")["cum_n"].tolist() == pdf["cum_n"].tolist()


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_splits_do_not_depend_on_layout(spark, partitions):
    base = spark.range(3000).select(
        F.concat(F.lit("m"), "id").alias("id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    moved = base.repartition(partitions)

    def ids(df):
        return sorted(r["id"] for r in df.collect())

    train, test = random_split(base)
    train_2, test_2 = random_split(moved)
    assert ids(test) == ids(test_2) and ids(train) == ids(train_2)
    assert len(ids(train)) + len(ids(test)) == 3000 and not set(ids(train)) & set(ids(test))
    assert 500 < len(ids(test)) < 700
    folds = [{r["id"]: r["fold"] for r in kfold(d).collect()} for d in (base, moved)]
    assert folds[0] == folds[1] and set(folds[0].values()) == {0, 1, 2}


@pytest.mark.parametrize("ratio", [0.2, 0.35, 0.0, 1.0])
def test_stratified_split_is_exact(spark, ratio):
    base = spark.range(5003).select(
        F.col("id"), F.when(F.col("id") < 17, None).otherwise(F.col("id") % 4 == 0).alias("label"))
    expected = {}
    sizes = {r["label"]: r["n"] for r in base.groupBy("label").agg(F.count("*").alias("n")).collect()}
    for options in ({}, {"single_task_rows": 20}):
        out = stratified_split(base.repartition(5), test_ratio=ratio, **options)
        assert out.columns == ["id", "label", "is_test"] and out.count() == 5003
        taken = {r["label"]: r["n"] for r in
                 out.groupBy("label").agg(F.count_if("is_test").alias("n")).collect()}
        assert taken == {k: math.floor(round(n * ratio, 6)) for k, n in sizes.items()}
        chosen = {r["id"] for r in out.filter("is_test").collect()}
        assert chosen == expected.setdefault("ids", chosen)


@pytest.mark.parametrize("n, reads_wanted", [(150_000, 2), (40, 3)])
def test_stratified_split_reads(spark, n, reads_wanted):
    """A counting pass-through: once for the cuts, once for the flags; a few rows once more."""
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    source = spark.range(n).select("id", F.lit("x").alias("label")).repartition(4)
    out = stratified_split(source.mapInPandas(count, source.schema))
    hashes = F.md5(F.concat(F.lit("42:"), F.col("id").cast("string")))
    cut = source.select(hashes.alias("h")).orderBy("h").limit(n // 5).agg(F.max("h")).first()[0]
    assert out.filter(F.col("is_test") != (hashes <= F.lit(cut))).isEmpty()
    assert out.filter("is_test").count() == n // 5
    before = reads.value
    stratified_split(source.mapInPandas(count, source.schema)).agg(F.sum(F.col("is_test").cast("int"))).collect()
    assert reads.value - before == reads_wanted * n


def test_stratified_split_with_equal_keys(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("id"), F.lit(1).alias("label"))
    sides = stratified_split(rows).groupBy("id").agg(F.count_distinct("is_test").alias("n"))
    assert sides.filter("n > 1").isEmpty()


def test_sample_errors_takes_what_is_there(spark):
    rows = spark.createDataFrame(
        [(i, 0, 1) for i in range(9)] + [(20, 1, 0), (21, 1, 1)], "id int, label int, prediction int")
    got = sample_errors(rows).groupBy("error").count().collect()
    assert {r["error"]: r["count"] for r in got} == {"false_positive": 5, "false_negative": 1}


def test_correlation_against_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(300, 4)) + 1e6, columns=list("abcd"))
    pdf["b"] += pdf["a"]
    pdf["flat"], pdf["void"] = 0.1, np.nan
    pdf.loc[::3, "c"] = np.nan
    # d is constant wherever e is present.
    pdf["e"] = np.where(np.arange(300) < 50, rng.normal(size=300), np.nan)
    pdf.loc[:49, "d"] = 7.7
    names = list(pdf.columns)
    got = P.corr_matrix(spark.createDataFrame(pdf).repartition(4), [*names, "a"]).toPandas()
    assert len(got) == len(names) ** 2
    wide = got.pivot(index="a", columns="b", values="r").loc[names, names].astype(float)
    expected = pdf.corr()
    expected.loc["d", "e"] = expected.loc["e", "d"] = np.nan
    np.testing.assert_allclose(wide.to_numpy(), expected.to_numpy(), atol=1e-6)


def test_histogram_and_bins(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.exponential(size=500), [9.0, 9.0]])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "flat": 3.0, "void": np.nan}))
    for bins in (7, None):
        got = P.histogram(df, "x", bins).orderBy("bin").toPandas()
        n, edges = np.histogram(x, "auto" if bins is None else bins)
        shown = n >= (1 if bins is None else 0)
        assert got["n"].tolist() == n[shown].tolist()
        np.testing.assert_allclose(got["bin_start"], edges[:-1][shown])
        np.testing.assert_allclose(got["bin_end"], edges[1:][shown])
    flat = P.histogram(df, "flat", 4).orderBy("bin").toPandas()
    n, edges = np.histogram(np.full(502, 3.0), 4)
    assert flat["n"].tolist() == n.tolist() and flat["bin_start"].tolist() == edges[:-1].tolist()
    assert P.auto_bins(df, "flat") == 1
    assert P.histogram(df, "void").count() == 0


def test_box_stats_by_hand(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(1, v) for v in values] + [(0, 5.0)], "g int, x double")
    got = {r["g"]: r.asDict() for r in P.box_stats(df, ["x"], "g").collect()}
    assert got[1] == {"g": 1, "column": "x", "n": 5, "q1": 2.0, "median": 3.0, "q3": 4.0,
                      "whisker_lo": 1.0, "whisker_hi": 4.0, "n_outliers": 1}
    assert got[0]["whisker_lo"] == got[0]["whisker_hi"] == 5.0


def test_missing_values_in_profiles(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (None, None), (float("nan"), "a"), (3.0, "b")], "x double, s string")
    assert {tuple(r) for r in P.null_counts(df).collect()} == {("x", 2), ("s", 1)}
    row = P.describe_numeric(df, ["x"]).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (2, 2.0, 1.0, 3.0)
    assert tuple(P.describe_string(df, "s").first()) == (3, 2, "a", 2)
    assert [tuple(r) for r in P.value_counts(df, "s").collect()] == [("a", 2), ("b", 1)]
    assert {r["s"]: r["share"] for r in P.share_by_category(df, "s").collect()} == {
        "a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}
    empty = df.filter("false")
    assert tuple(P.describe_string(empty, "s").first()) == (0, 0, None, None)
    assert P.describe_numeric(empty, ["x"]).count() == 0


def test_profile_report_agrees_with_its_parts(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"x": rng.normal(size=400), "y": rng.integers(0, 9, 400).astype(float),
                        "c": rng.choice(["a", "b"], 400), "label": rng.integers(0, 2, 400)})
    df = spark.createDataFrame(pdf)
    report = profile_report(df, ["x", "y"], ["c"], "c", "label")
    assert {r["column"]: r["count"] for r in report["describe"]().collect()} == {"x": 400, "y": 400}
    for c in "xy":
        n, _ = np.histogram(pdf[c], "auto")
        got = [r["n"] for r in report[f"histogram.{c}"]().orderBy("bin").collect()]
        assert got == n[n > 0].tolist()
    for name, table in report.items():
        assert table().count() > 0, name


def test_positive_probability(spark):
    df = spark.createDataFrame([(Vectors.dense([0.3, 0.7]),)], ["probability"])
    assert df.select(vector_to_array("probability")[1]).first()[0] == 0.7


def test_box_stats_read_the_table_twice(spark):
    """A counting pass-through; brackets are narrow, so fences are found between runs of values."""
    draw = np.random.default_rng(5)
    pdf = pd.DataFrame({
        "x": np.round(draw.standard_t(2, 30_000), 3), "y": draw.exponential(3, 30_000), "g": draw.integers(0, 3, 30_000)})
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    source = spark.createDataFrame(pdf).repartition(4)
    df = source.mapInPandas(count, source.schema)
    boxes = P.box_stats(df, ["x", "y"], "g", sketch_size=1024).collect()
    assert reads.value == 2 * len(pdf)
    for r in boxes:
        v = pdf.loc[pdf["g"] == r["g"], r["column"]].to_numpy()
        q1, mid, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, mid, q3))
        assert (r["n"], r["n_outliers"]) == (len(v), len(v) - len(inside))
        assert (r["whisker_lo"], r["whisker_hi"]) == (min(inside.min(), q1), max(inside.max(), q3))


def test_all_histograms_in_one_read(spark):
    draw = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": draw.normal(size=500), "b": 3.0, "c": draw.integers(0, 9, 500).astype(float)})
    pdf.loc[:20, "a"] = np.nan
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    source = spark.createDataFrame(pdf)
    df = source.mapInPandas(count, source.schema)
    bins = {c: (7, *source.agg(*[f(F.nanvl(c, F.lit(None))) for f in (F.min, F.max)]).first()) for c in "abc"}
    rows = P.histograms(df, bins | {"void": (1, None, None)}).collect()
    assert reads.value == len(pdf)
    for c in "abc":
        one = P.histogram(source, c, *[bins[c][0]], extent=bins[c][1:], keep_empty=False).collect()
        got = {(r["bin"], r["bin_start"], r["bin_end"], r["n"]) for r in rows if r["column"] == c}
        assert got == {(r["bin"], r["bin_start"], r["bin_end"], r["n"]) for r in one}


def test_describe_leaves_out_columns_without_values(spark):
    rows = spark.createDataFrame(
        [(1.0, None, math.nan), (3.0, None, None)], "x double, void double, nan double")
    got = P.describe_numeric(rows, ["x", "void", "nan"]).collect()
    assert [(r["column"], r["count"], r["q50"]) for r in got] == [("x", 2, 2.0)]
    assert P.describe_numeric(rows.filter("x < 0"), ["x", "void"]).count() == 0


def test_profile_report_reads_the_table_once_for_all_histograms(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    rows = spark.range(300).select((F.col("id") % 37).cast("double").alias("v"))
    watched = rows.withColumn("v", F.udf(counted, "double").asNondeterministic()("v"))
    report = profile_report(watched, ["v"])
    assert report["histogram.v"]().agg(F.sum("n")).first()[0] == 300
    assert report["describe"]().first()["max"] == 36.0
    assert seen.value == 300
