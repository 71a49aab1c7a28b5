"""Forest and net: layout independence, training progress, persistence, streaming."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import modelling
from tabstride.operators import forest as RF
from tabstride.operators import net as N
from tabstride.operators.columns import positive_prob
from tabstride.operators.metrics import binary_metrics, roc_auc
from tabstride.operators.scaling import FittedScaler, fit_scaler
from tabstride.operators.splits import label_sample, random_split
from tabstride.plans import error_report, evaluate, evaluate_run, prepare, score_batch, train_net
from tabstride.plans import training
from tabstride.sources.artefacts import load_forest, load_net, load_scaler, read_runs, save_forest

NAMES = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1200, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(scale=0.4, size=1200) > 0.3).astype(int)
    pdf = pd.DataFrame(x, columns=NAMES).assign(
        id=[f"r{i}" for i in range(1200)], label=y, standard_value=np.where(y, 10.0, 5000.0))
    return spark.createDataFrame(pdf).persist()


@pytest.fixture(scope="module")
def vectors(rows):
    return prepare(rows, feats=NAMES).persist()


def test_prepare_equals_built_in_scaler(rows, vectors):
    assembled = VectorAssembler(inputCols=NAMES, outputCol="v").transform(rows)
    scaler = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True)
    theirs = scaler.fit(assembled).transform(assembled).select("id", vector_to_array("s").alias("s"))
    both = vectors.select("id", "label", vector_to_array("features").alias("f")).join(theirs, "id")
    pdf = both.toPandas()
    assert len(pdf) == 1200
    np.testing.assert_allclose(np.stack(pdf["f"]), np.stack(pdf["s"]), atol=1e-9)
    assert pdf["label"].sum() == rows.agg(F.sum("label")).first()[0]


def test_forest_does_not_depend_on_layout(vectors):
    def probabilities(parts):
        model = RF.rf_fit(vectors.repartition(parts), {"numTrees": 5, "maxDepth": 4})
        scored = positive_prob(RF.predict_forest(model, vectors), "prob")
        return scored.select("id", "prob").orderBy("id").toPandas()["prob"].tolist()

    first = probabilities(1)
    assert first == probabilities(4) == probabilities(13)


def test_param_grid_has_36_settings():
    grid = RF.param_grid(RF._forest(42))
    assert len(grid) == 36
    assert len({tuple(sorted((p.name, v) for p, v in g.items())) for g in grid}) == 36


def test_cross_validation(vectors, tmp_path):
    grid = {"numTrees": [3, 6], "maxDepth": [2, 4], "minInstancesPerNode": [1],
            "subsamplingRate": [1.0]}
    search = RF.rf_cross_validate(vectors, grid, folds=2)
    assert len(search.avgMetrics) == 4 and min(search.avgMetrics) > 0.7
    best = RF.best_params(search)
    index = int(np.argmax(search.avgMetrics))
    assert best == {p.name: v for p, v in search.getEstimatorParamMaps()[index].items()}
    quality = evaluate(search, vectors).first()
    assert quality["auc"] > 0.8 and quality["accuracy"] > 0.7

    save_forest(search.bestModel, str(tmp_path / "forest"))
    again = load_forest(str(tmp_path / "forest"))
    assert evaluate(again, vectors).first() == quality


def test_error_report_agrees_with_evaluation(vectors):
    model = RF.rf_fit(vectors, {"numTrees": 5, "maxDepth": 3})
    scored = positive_prob(RF.predict_forest(model, vectors), "prob").select(
        "id", "label", "prob", "prediction")
    report = error_report(scored)
    assert report["roc_auc"].first()["auc"] == pytest.approx(evaluate(model, vectors).first()["auc"])
    cells = {r["actual"]: (r["predicted_0"], r["predicted_1"])
             for r in report["confusion_matrix"].collect()}
    errors = report["error_counts"].first()
    assert (cells[0][1], cells[1][0]) == (errors["false_positives"], errors["false_negatives"])
    assert sum(map(sum, cells.values())) == 1200
    assert report["error_samples"].count() == min(5, cells[0][1]) + min(5, cells[1][0])


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    net = N.NetWeights.random([3, 4, 2, 1], 1)
    pdf = pd.DataFrame(rng.normal(size=(20, 3)), columns=NAMES).assign(
        label=rng.integers(0, 2, 20).astype(float))

    def sums(layers):
        return N._gradient(layers, pdf[NAMES].to_numpy(), pdf["label"].to_numpy())

    flat, total = N._flatten(net.layers), sums(net.layers)
    for slot in range(flat.size):
        step = np.zeros_like(flat)
        step[slot] = 1e-6
        up = sums(N._unflatten(flat + step, net.layers))[-1]
        down = sums(N._unflatten(flat - step, net.layers))[-1]
        assert total[slot] == pytest.approx((up - down) / 2e-6, abs=1e-4)


def test_net_does_not_depend_on_layout(rows):
    flat = [
        N._flatten(N.mlp_fit(rows.repartition(parts), NAMES, epochs=3, lanes=3)[0].layers)
        for parts in (1, 4, 13)
    ]
    np.testing.assert_allclose(flat[0], flat[1], atol=1e-6)
    np.testing.assert_allclose(flat[0], flat[2], atol=1e-6)


def test_gradient_over_executors(rows):
    net = N.NetWeights.random([3, 4, 1], 1)
    pdf = rows.toPandas()
    expected = N._gradient(net.layers, pdf[NAMES].to_numpy(), pdf["label"].to_numpy(float))
    got = N.gradient_sums(rows.repartition(5), NAMES, net).orderBy("slot").toPandas()["total"]
    np.testing.assert_allclose(got, expected, rtol=1e-9, atol=1e-9)


def test_net_flow_keeps_what_it_made(spark, rows, tmp_path):
    path = str(tmp_path / "run")
    predictions = train_net(rows, path, "r1", NAMES, epochs=4, lanes=2)
    assert predictions.count() == sum(r["count"] // 5 for r in rows.groupBy("label").count().collect())
    logged = {r["key"]: r["value"] for r in read_runs(spark, f"{path}/runs").collect()}
    quality = binary_metrics(predictions, 0.35).first()
    assert float(logged["accuracy"]) == quality["accuracy"] and float(logged["f1"]) == quality["f1"]
    assert logged["decision_threshold"] == "0.35" and {"auc", "final_loss", "epochs"} <= set(logged)
    again = score_batch(rows, NAMES, load_scaler(spark, f"{path}/scaler"),
                        load_net(spark, f"{path}/net"), id_col="id").join(predictions, "id")
    assert again.filter("abs(prob - prob_active) > 1e-12 OR prediction <> pred_active").count() == 0


def test_net_query_trains_in_full(spark, tmp_path, monkeypatch):
    path, fit, given = str(tmp_path / "run"), training.mlp_fit, {}

    def watched(df, *args, **options):
        given.update(options)
        return fit(df, *args, **options)

    monkeypatch.setattr(training, "mlp_fit", watched)
    monkeypatch.setattr(modelling, "scratch_path", lambda *_: path)
    assert modelling.net_flow(spark, "/root/testdata/sf0.001").count() > 0
    logged = {r["key"]: r["value"] for r in read_runs(spark, f"{path}/runs").collect()}
    assert logged["epochs"] == "50" and given.get("batch_size", 32) == 32


def test_evaluation_run_keeps_what_it_made(spark, vectors, tmp_path):
    path = str(tmp_path / "run")
    model = RF.rf_fit(vectors, {"numTrees": 5, "maxDepth": 3})
    predictions = evaluate_run(model, vectors, path, "r1")
    assert predictions.filter("custom_prediction <> int(prob >= 0.38)").count() == 0
    logged = {r["key"]: r["value"] for r in read_runs(spark, f"{path}/runs").collect()}
    quality = evaluate(load_forest(f"{path}/model"), vectors).first()
    assert float(logged["auc"]) == pytest.approx(quality["auc"])
    assert float(logged["accuracy"]) == quality["accuracy"] and logged["decision_threshold"] == "0.38"
    # Error analysis on the saved model.
    scored = predictions.select("id", "label", "prob", "prediction")
    assert error_report(scored)["roc_auc"].first()["auc"] == pytest.approx(quality["auc"])


@pytest.mark.parametrize("lanes", [1, 3])
def test_net_learns(spark, rows, lanes):
    net, losses = N.mlp_fit(rows, NAMES, epochs=12, lanes=lanes, learning_rate=0.01)
    assert [w.shape for w, _ in net.layers] == [(32, 3), (16, 32), (1, 16)]
    assert len(losses) == 12 and losses[-1] < losses[0] - 0.1
    after = N.epoch_loss(rows, NAMES, net).first()["loss"]
    assert after < losses[0]
    scored = N.mlp_score(rows, NAMES, net, "prob")
    assert roc_auc(scored).first()["auc"] > 0.8


def test_perceptron_baseline(vectors):
    model = N.perceptron_fit(vectors, hidden=(5,), epochs=20)
    assert roc_auc(positive_prob(model.transform(vectors), "prob")).first()["auc"] > 0.7


def test_scoring_a_stream_equals_scoring_a_batch(spark, rows, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows.select("id", *NAMES).repartition(3).write.parquet(source)
    fitted: FittedScaler = fit_scaler(rows, NAMES, ddof=0)
    net = N.NetWeights.random([3, 4, 1], 3)
    stream = spark.readStream.schema("id string, x0 double, x1 double, x2 double").parquet(source)
    query = (
        score_batch(stream, NAMES, fitted, net)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination(120)
    got = spark.read.parquet(sink).orderBy("id").toPandas()
    expected = score_batch(rows, NAMES, fitted, net).orderBy("id").toPandas()
    pd.testing.assert_frame_equal(got, expected)


def test_prefix_votes_are_those_of_the_forest(vectors):
    model = RF.rf_fit(vectors, {"numTrees": 7, "maxDepth": 5, "minInstancesPerNode": 2})
    table = RF.node_table(model)
    rows = positive_prob(RF.predict_forest(model, vectors), "prob").select("features", "prob").toPandas()
    x = np.stack([v.toArray() for v in rows["features"]])
    votes = table.votes(x, [7, 3])
    np.testing.assert_allclose(votes[:, 0], rows["prob"], atol=1e-12)
    trees = [[t.predictProbability(v)[1] for t in model.trees[:3]] for v in rows["features"][:20]]
    np.testing.assert_allclose(votes[:20, 1], np.mean(trees, axis=1), atol=1e-12)


def test_a_cut_forest_is_a_shallower_one(vectors):
    """The first tree of a seeded forest without drawn features grows alike to any depth."""
    params = {"numTrees": 3, "featureSubsetStrategy": "all"}
    deep = RF.node_table(RF.rf_fit(vectors, params | {"maxDepth": 6}))
    x = np.random.default_rng(0).normal(size=(500, 3)) * 2
    np.testing.assert_array_equal(deep.cut(6).votes(x, [3]), deep.votes(x, [3]))
    for depth in (0, 1, 2, 4):
        shallow = RF.node_table(RF.rf_fit(vectors, params | {"maxDepth": depth}))
        np.testing.assert_allclose(deep.cut(depth).votes(x, [1, 3]), shallow.votes(x, [1, 3]), atol=1e-12)


def test_areas_of_folds_are_exact(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({
        "fold": rng.integers(0, 2, 400), "setting": rng.integers(0, 3, 400),
        "label": rng.integers(0, 2, 400), "prob": rng.integers(0, 9, 400) / 8.0})
    pdf.loc[pdf["setting"] == 2, "label"] = 1
    for r in RF.fold_areas(spark.createDataFrame(pdf)).collect():
        part = pdf[(pdf["fold"] == r["fold"]) & (pdf["setting"] == r["setting"])]
        pos, neg = (part.loc[part["label"] == v, "prob"].to_numpy() for v in (1, 0))
        if not len(neg):
            assert r["area"] is None
            continue
        wins = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
        assert r["area"] == pytest.approx(wins / (len(pos) * len(neg)))


def test_lanes_do_not_depend_on_tasks(rows):
    def weights(partitions, lanes):
        net, _ = N.mlp_fit(rows, NAMES, epochs=3, lanes=lanes, partitions=partitions)
        return N._flatten(net.layers)

    first = weights(1, 64)
    for partitions in (4, 13):
        np.testing.assert_allclose(weights(partitions, 64), first, rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(weights(4, 1), weights(1, 1), rtol=1e-6, atol=1e-9)


def test_parts_and_lanes_grow_with_the_rows(rows, monkeypatch):
    monkeypatch.setattr(RF, "PART_ROWS", 100)
    assert RF.fixed_layout(rows, "id").rdd.getNumPartitions() == 12
    monkeypatch.setattr(N, "LANE_ROWS", 100)
    seen = []
    monkeypatch.setattr(N, "_unflatten", lambda flat, like, real=N._unflatten: seen.append(1) or real(flat, like))
    N.mlp_fit(rows, NAMES, epochs=2)
    assert len(seen) == 2


def _plain_adam(layers, rows, size, rate, step):
    """Adam on one lane, batch by batch: weights, moments, loss and steps."""
    flat = N._flatten(layers)
    first, second, loss = np.zeros_like(flat), np.zeros_like(flat), 0.0
    for at in range(0, len(rows), size):
        batch = rows[at : at + size]
        sums = N._gradient(N._unflatten(flat, layers), batch[:, :-1], batch[:, -1])
        gradient, step, loss = sums[:-1] / len(batch), step + 1, loss + sums[-1]
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        change = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        flat = flat - rate * change
    return flat, first, second, loss, -(-len(rows) // size)


@pytest.mark.parametrize("hidden", [(), (5,), (32, 16)])
@pytest.mark.parametrize("group_bytes", [2_000, 16_000_000])
def test_lanes_side_by_side_learn_as_alone(monkeypatch, hidden, group_bytes):
    rng = np.random.default_rng(5)
    layers = N.NetWeights.random([3, *hidden, 1], 2).layers
    sizes = [100, 1, 64, 1500, 33, 8, 97]
    lanes = [np.column_stack([rng.normal(size=(n, 3)), rng.integers(0, 2, n)]) for n in sizes]
    zero = np.zeros(N._flatten(layers).size)
    monkeypatch.setattr(N, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(N, "PACK_BYTES", 500)
    calls = []
    real = N._Lanes._step
    monkeypatch.setattr(N._Lanes, "_step", lambda *given: calls.append(1) or real(*given))
    table = pa.table({
        "_lane": pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
        **{f"x{i}": np.concatenate(lanes)[:, i] for i in range(4)},
    })
    packed = list(N._packed(4)(iter(table.to_batches(max_chunksize=70))))
    assert sum(b.num_rows for b in packed) < sum(sizes) / 4
    (out,) = N._lane_epochs(layers, (zero, zero), 3, 0.01, 32)(iter(packed))
    alone = [_plain_adam(layers, rows, 32, 0.01, 3) for rows in lanes]
    expected = [sum(n * a[i] for n, a in zip(sizes, alone)) for i in range(3)]
    ends = [sum(a[3] for a in alone), sum(sizes), sum(a[4] for a in alone), len(sizes)]
    np.testing.assert_allclose(out.column("total").to_numpy(), [*np.concatenate(expected), *ends], rtol=1e-9, atol=1e-9)
    if group_bytes > 1_000_000:
        assert len(calls) == max(a[4] for a in alone)


def _joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_net_query_joins_its_rows_once(spark, monkeypatch):
    given = []

    class Stop(Exception):
        pass

    def watched(rows, *args, **options):
        given.append(rows)
        raise Stop

    monkeypatch.setattr(modelling, "train_net", watched)
    with pytest.raises(Stop):
        modelling.net_flow(spark, "/root/testdata/sf0.001")
    assert _joins(given[0]) == 0 and given[0].columns == ["id", "label", *modelling.FEATURES]


SMALL = "/root/testdata/sf0.001"


def test_prepared_rows_are_joined_once(spark):
    """The queries of fits, searches, scores and error reports all read these rows."""
    rows = modelling.prepared(spark, SMALL)
    assert _joins(rows) == 0 and rows.columns == ["id", "features", "label"]


def test_error_analysis_prepares_its_rows_once(spark, monkeypatch):
    calls, real = [], modelling.prepare
    monkeypatch.setattr(modelling, "prepare", lambda *a, **o: calls.append(1) or real(*a, **o))
    assert modelling.saved_analysis(spark, SMALL).count() == 2
    assert len(calls) == 1


def test_sample_to_fit_on_is_stored(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    watched = rows.withColumn("x0", F.udf(counted, "double").asNondeterministic()("x0"))
    sample = label_sample(watched, 50)
    for _ in range(3):
        assert sample.count() == 50 and sample.agg(F.sum("x0")).first()[0] is not None
    assert seen.value == rows.count()


def test_median_query_joins_its_rows_once(spark, monkeypatch):
    given, real = [], modelling.impute
    monkeypatch.setattr(modelling, "impute", lambda df, *a: given.append(df) or real(df, *a))
    filled = modelling.imputed_median(spark, SMALL)
    assert _joins(given[0]) == 0 and filled.filter("f3 IS NULL").isEmpty()


def test_net_rows_do_not_fill_the_memory(rows, monkeypatch):
    """Tasks take few rows, as a task's runs go to Python as one batch, and the runs lie on disk."""
    from pyspark import StorageLevel
    from pyspark.sql.classic.dataframe import DataFrame

    kept, real = [], DataFrame.persist

    def watched(df, *level):
        kept.append((level, df.rdd.getNumPartitions()))
        return real(df, *level)

    monkeypatch.setattr(DataFrame, "persist", watched)
    N.mlp_fit(rows, NAMES, epochs=1, lanes=16, partitions=2)
    assert kept == [((StorageLevel.DISK_ONLY,), 2)]
    assert N.TASK_ROWS * 8 * 8 < 10_000_000


def test_runs_of_rows_are_compressed_without_loss():
    rng = np.random.default_rng(3)
    values = np.column_stack([rng.normal(size=900), np.full(900, np.pi), rng.integers(0, 2, 900)])
    lanes = np.repeat([0, 4, 5], [500, 1, 399])
    table = pa.table({"_lane": pa.array(lanes, pa.int32()), **{f"x{i}": values[:, i] for i in range(3)}})
    (packed,) = N._packed(3)(iter(table.to_batches()))
    sizes, data = packed.column("size").to_pylist(), packed.column("data").to_pylist()
    assert sum(sizes) == 900 and sum(map(len, data)) < values.nbytes
    back = [np.frombuffer(pa.decompress(d, 24 * n, N.PACK_CODEC)) for n, d in zip(sizes, data)]
    np.testing.assert_array_equal(np.concatenate(back).reshape(-1, 3), values)


@pytest.fixture
def many_prepared(spark, monkeypatch):
    """3,000 prepared rows in the place of those of the queries; their number in the train part."""
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame(rng.normal(size=(3000, 3)), columns=NAMES).assign(
        id=[f"m{i}" for i in range(3000)], standard_value=rng.choice([10.0, 5000.0], 3000))
    table = prepare(spark.createDataFrame(pdf), feats=NAMES).persist()
    monkeypatch.setattr(modelling, "prepared", lambda *_: table)
    yield random_split(table)[0].count()
    table.unpersist()


def _rows_given(monkeypatch, holder, name):
    """Numbers of rows of the tables that a function is given from now on."""
    seen, real = [], getattr(holder, name)
    monkeypatch.setattr(holder, name, lambda df, *a, **o: seen.append(df.count()) or real(df, *a, **o))
    return seen


def test_perceptron_query_fits_on_all_train_rows(spark, monkeypatch, many_prepared):
    seen = _rows_given(monkeypatch, N, "perceptron_fit")
    assert modelling.perceptron(spark, "").count() == 3000 - many_prepared
    assert seen == [many_prepared] and many_prepared > 2300


def test_forest_queries_fit_on_all_train_rows(spark, monkeypatch, many_prepared):
    seen = _rows_given(monkeypatch, RF, "rf_fit")
    assert modelling.predictions(spark, "").count() == 3000 - many_prepared
    assert seen == [many_prepared] and many_prepared > 2300


def test_search_query_fits_on_all_train_rows(spark, monkeypatch, many_prepared):
    seen, real = [], RF.rf_cross_validate

    def small(df, **options):
        seen.append((df.count(), options.get("partitions")))
        return real(df, {"numTrees": [2], "maxDepth": [2]}, **options)

    monkeypatch.setattr(RF, "rf_cross_validate", small)
    assert len(modelling.search(spark, "").avgMetrics) == 1
    assert seen == [(many_prepared, None)] and many_prepared > 2300


def test_fewer_fits_at_a_time_on_many_parts(vectors, monkeypatch):
    pools, real = [], RF.ThreadPool
    monkeypatch.setattr(RF, "ThreadPool", lambda n: pools.append(n) or real(n))
    grid = {"numTrees": [2], "maxDepth": [2]}
    areas = [RF.rf_cross_validate(vectors, grid, folds=2, partitions=8, parallelism=n).avgMetrics for n in (1, 8)]
    RF.rf_cross_validate(vectors, grid, folds=2, partitions=32, parallelism=8)
    assert pools == [1, 8, 2] and areas[0] == areas[1]
