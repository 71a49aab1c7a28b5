"""Small ReLU net with one logit output: training, loss and scoring on executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstride.constants import (
    NET_BATCH_SIZE,
    NET_EPOCHS,
    NET_LAYERS,
    NET_LEARNING_RATE,
    SEED,
)
from tabstride.functions import column_value, named, sigmoid

# Rows of a lane, and of a task that trains several lanes, unless given.  A task's runs go to Python
# as one Arrow batch, which is held several times outside the heap, so a task is small.
LANE_ROWS = 4096
TASK_ROWS = 131_072
# Bytes of a run of rows before it is compressed; lanes, and bytes, that a task holds and trains side by side.
PACK_BYTES = 16_384
PACK_CODEC = "lz4"
GROUP_LANES = 32
GROUP_BYTES = 16_000_000
# Rows per lane that are laid out for training at a time.
WINDOW_ROWS = 256
# Tasks that sum the results of an epoch.
SUM_TASKS = 8


@dataclass(frozen=True)
class NetWeights:
    """One ``(w, b)`` pair per layer; ``w`` has a row per output unit."""

    layers: tuple[tuple[np.ndarray, np.ndarray], ...]

    @staticmethod
    def from_rule(
        sizes: Sequence[int],
        w: Callable[[int, int, int], float],
        b: Callable[[int, int], float],
    ) -> NetWeights:
        """Weights ``w(layer, out, in)`` and ``b(layer, out)`` for given layer sizes."""
        pairs = []
        for n, (fan_in, fan_out) in enumerate(zip(sizes, sizes[1:])):
            matrix = [[w(n, o, i) for i in range(fan_in)] for o in range(fan_out)]
            pairs.append((np.array(matrix, float), np.array([b(n, o) for o in range(fan_out)])))
        return NetWeights(tuple(pairs))

    @staticmethod
    def random(sizes: Sequence[int] = NET_LAYERS, seed: int = SEED) -> NetWeights:
        """Uniform start within one over the root of the fan-in."""
        rng = np.random.default_rng(seed)
        pairs = []
        for fan_in, fan_out in zip(sizes, sizes[1:]):
            bound = 1.0 / np.sqrt(fan_in)
            pairs.append(
                (rng.uniform(-bound, bound, (fan_out, fan_in)), rng.uniform(-bound, bound, fan_out))
            )
        return NetWeights(tuple(pairs))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """Table ``layer, out, w, b``, one row per unit."""
        rows = [
            (n, o, [float(v) for v in w[o]], float(b[o]))
            for n, (w, b) in enumerate(self.layers)
            for o in range(len(b))
        ]
        return spark.createDataFrame(
            rows, "layer int, out int, w array<double>, b double"
        ).coalesce(1)

    @staticmethod
    def from_df(df: DataFrame) -> NetWeights:
        rows = df.orderBy("layer", "out").collect()
        pairs = []
        for n in sorted({r["layer"] for r in rows}):
            units = [r for r in rows if r["layer"] == n]
            pairs.append((np.array([r["w"] for r in units]), np.array([r["b"] for r in units])))
        return NetWeights(tuple(pairs))


def _forward(layers, x: np.ndarray) -> list[np.ndarray]:
    """Activations of every layer, input first, logits last."""
    seen = [x]
    for n, (w, b) in enumerate(layers):
        z = seen[-1] @ w.T + b
        seen.append(z if n == len(layers) - 1 else np.maximum(z, 0.0))
    return seen


def net_logit(feats: Sequence[str | Column], weights: NetWeights) -> Column:
    """Logit column, computed per Arrow batch."""
    layers = weights.layers

    @F.pandas_udf("double")
    def forward(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            # A single feature comes as a series of its own.
            columns = columns if isinstance(columns, tuple) else (columns,)
            x = np.column_stack([c.to_numpy(float) for c in columns])
            yield pd.Series(_forward(layers, x)[-1][:, 0])

    return forward(*[F.col(f) if isinstance(f, str) else f for f in feats])


def mlp_score(
    df: DataFrame, feats: Sequence[str], weights: NetWeights, out: str = "prob_active"
) -> DataFrame:
    """Add the probability of class 1."""
    return df.withColumn("_logit", net_logit(feats, weights)).select(
        *[c for c in df.columns if c != out], sigmoid("_logit").alias(out)
    )


def bce(z: Column | str, y: Column | str) -> Column:
    """Binary cross-entropy of a logit, in the form that does not overflow."""
    z = F.col(z) if isinstance(z, str) else z
    y = F.col(y) if isinstance(y, str) else y
    return F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - z * y


def epoch_loss(
    df: DataFrame, feats: Sequence[str], weights: NetWeights, label: str = "label"
) -> DataFrame:
    """Mean loss over all rows; a row without a feature or a label is an error."""
    scored = df.select(net_logit(feats, weights).alias("_z"), named(label).alias("_y")).select(
        *[
            F.coalesce(column_value(c), F.raise_error(F.lit("missing value in a row")).cast("double"))
            .alias(out)
            for c, out in (("_z", "z"), ("_y", "y"))
        ]
    )
    return scored.agg(F.avg(bce("z", "y")).alias("loss"))


def _gradient(layers, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Summed gradient of all weights, then the summed loss."""
    seen = _forward(layers, x)
    z = seen[-1][:, 0]
    delta = (1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y)[:, None]
    parts = []
    for n in range(len(layers) - 1, -1, -1):
        parts.append((delta.T @ seen[n], delta.sum(axis=0)))
        delta = (delta @ layers[n][0]) * (seen[n] > 0)
    flat = [part.ravel() for pair in reversed(parts) for part in pair]
    loss = np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0.0) - z * y
    return np.concatenate([*flat, [loss.sum()]])


def gradient_sums(
    df: DataFrame, feats: Sequence[str], weights: NetWeights, label: str = "label"
) -> DataFrame:
    """``slot, total``: gradient of the loss summed over all rows per weight, the loss last.

    Weights are counted layer by layer: all of ``w`` row by row, then ``b``.
    """
    layers = weights.layers

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(_flatten(layers)) + 1)
        for frame in frames:
            total += _gradient(layers, frame[list(feats)].to_numpy(float), frame["label"].to_numpy(float))
        yield pd.DataFrame({"slot": np.arange(len(total)), "total": total})

    rows = df.select(*[named(f) for f in feats], named(label).alias("label"))
    return rows.mapInPandas(run, "slot int, total double").groupBy("slot").agg(
        F.sum("total").alias("total")
    )


def _flatten(layers) -> np.ndarray:
    return np.concatenate([part.ravel() for pair in layers for part in pair])


def _unflatten(flat: np.ndarray, like) -> tuple:
    pairs, at = [], 0
    for w, b in like:
        pairs.append(
            (flat[at : at + w.size].reshape(w.shape), flat[at + w.size : at + w.size + b.size])
        )
        at += w.size + b.size
    return tuple(pairs)


class _Lanes:
    """One epoch of Adam over lanes side by side, each in batches of ``batch_size`` of its own rows.

    Every lane has its own weights and moments; a step multiplies small matrices lane by lane in
    one numpy call.  A layer is one matrix here, the bias its last column, and moments are kept
    divided by one minus their decay rate.
    """

    # Adam decay rates and guard: fixed values.
    DECAY = 0.9, 0.999
    TINY = 1e-8

    def __init__(self, layers, moments, step: int, rate: float, batch_size: int, lanes: int):
        self.like = layers
        self.shapes = [(len(b), w.shape[1] + 1) for w, b in layers]
        self.ends = np.cumsum([0, *(o * i for o, i in self.shapes)])
        start = [self._joined(v) for v in (_flatten(layers), *moments)]
        for i, decay in enumerate(self.DECAY, 1):
            start[i] = start[i] / (1 - decay)
        self.flat, self.first, self.second = (np.repeat(v[None], lanes, axis=0) for v in start)
        self.step = step
        self.rate, self.batch_size = rate, batch_size
        self.seen, self.steps, self.loss = np.zeros(lanes), np.zeros(lanes), 0.0

    def _joined(self, flat: np.ndarray) -> np.ndarray:
        pairs = _unflatten(flat, self.like)
        return np.concatenate([np.column_stack([w, b]).ravel() for w, b in pairs])

    def _parted(self, joined: np.ndarray) -> np.ndarray:
        return _flatten([(m[0, :, :-1], m[0, :, -1]) for m in self._matrices(joined[None])])

    def _matrices(self, flat: np.ndarray) -> list[np.ndarray]:
        return [
            flat[:, at:to].reshape(len(flat), *shape)
            for at, to, shape in zip(self.ends[:-1], self.ends[1:], self.shapes)
        ]

    def learn(self, rows: Sequence[np.ndarray]) -> None:
        """Features and label of all rows of each lane, or of the next whole batches of a single one."""
        size = self.batch_size
        order = np.argsort([-len(r) for r in rows], kind="stable")
        rows = [rows[i] for i in order]
        state = [v[order] for v in (self.flat, self.first, self.second)]
        counts = np.array([len(r) for r in rows])
        steps = -(-counts // size)
        window = max(1, WINDOW_ROWS // size)
        for at in range(0, steps[0], window):
            # Longest lanes first, so those that still have rows lead.
            live = int(np.count_nonzero(steps > at))
            width = rows[0].shape[1]
            x = np.zeros((live, width, min(window, steps[0] - at) * size))
            y = np.zeros((live, 1, x.shape[2]))
            for i in range(live):
                part = rows[i][at * size : (at + window) * size]
                x[i, :-1, : len(part)] = part[:, :-1].T
                y[i, 0, : len(part)] = part[:, -1]
            x[:, -1] = 1.0
            for n in range(at, min(at + window, steps[0])):
                here = int(np.count_nonzero(steps > n))
                piece = slice((n - at) * size, (n - at + 1) * size)
                left = np.minimum(counts[:here] - n * size, size)
                self._step([v[:here] for v in state], x[:here, :, piece], y[:here, :, piece], left)
        for v, of in zip((self.flat, self.first, self.second), state):
            v[order] = of
        self.seen[order] += counts
        self.steps[order] += steps

    def _step(self, state, x: np.ndarray, y: np.ndarray, left: np.ndarray) -> None:
        """One batch of every lane; ``left`` rows of it are there, the others are padding."""
        flat, first, second = state
        layers = self._matrices(flat)
        seen = [x]
        for w in layers[:-1]:
            units = np.empty((len(x), w.shape[1] + 1, x.shape[2]))
            units[:, -1] = 1.0
            np.matmul(w, seen[-1], out=units[:, :-1])
            np.maximum(units[:, :-1], 0.0, out=units[:, :-1])
            seen.append(units)
        z = np.matmul(layers[-1], seen[-1])
        delta = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y
        loss = np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0.0) - z * y
        if (left < self.batch_size).any():
            there = (np.arange(self.batch_size) < left[:, None])[:, None]
            delta, loss = np.where(there, delta, 0.0), np.where(there, loss, 0.0)
        self.loss += loss.sum()
        delta /= left[:, None, None]
        gradient = np.empty(flat.shape)
        parts = self._matrices(gradient)
        for n in range(len(layers) - 1, -1, -1):
            np.matmul(delta, seen[n].transpose(0, 2, 1), out=parts[n])
            if n:
                delta = np.matmul(layers[n][:, :, :-1].transpose(0, 2, 1), delta)
                delta *= seen[n][:, :-1] > 0
        beta1, beta2 = self.DECAY
        self.step += 1
        first *= beta1
        first += gradient
        second *= beta2
        second += np.multiply(gradient, gradient, out=gradient)
        spread = np.sqrt((1 - beta2) / (1 - beta2**self.step))
        change = np.sqrt(second, out=gradient)
        change += self.TINY / spread
        np.divide(first, change, out=change)
        change *= self.rate * (1 - beta1) / (1 - beta1**self.step) / spread
        flat -= change

    def result(self) -> np.ndarray:
        """Weights and moments times rows, then loss sum, rows, steps and lanes."""
        sums = [self._parted(self.seen @ v) for v in (self.flat, self.first, self.second)]
        for i, decay in enumerate(self.DECAY, 1):
            sums[i] *= 1 - decay
        return np.concatenate(
            [*sums, [self.loss, self.seen.sum(), self.steps.sum(), np.count_nonzero(self.seen)]]
        )


def _packed(width: int):
    """Task function: the rows of a lane as compressed runs of doubles, so that an epoch reads few rows."""
    most = max(1, PACK_BYTES // (8 * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lanes = batch.column(0).to_numpy()
            rows = np.column_stack(
                [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
            ).astype(float)
            number, size, data = [], [], []
            for at, to in _runs(lanes):
                for i in range(at, to, most):
                    number.append(lanes[at])
                    size.append(min(most, to - i))
                    data.append(pa.compress(rows[i : i + size[-1]].tobytes(), PACK_CODEC, asbytes=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), pa.array(size, pa.int32()), pa.array(data, pa.binary())],
                ["lane", "size", "data"],
            )

    return run


def _runs(lanes: np.ndarray) -> list[tuple[int, int]]:
    edges = [0, *(np.flatnonzero(np.diff(lanes)) + 1).tolist(), len(lanes)]
    return [(at, to) for at, to in zip(edges[:-1], edges[1:]) if at < to]


def _lane_epochs(layers, moments, step: int, rate: float, batch_size: int):
    """Task function: every lane of the task starts at the common weights; results are summed.

    Lanes are trained side by side, so many at a time as ``GROUP_LANES`` and ``GROUP_BYTES``
    allow; a lane larger than that is trained alone, piece by piece.
    """
    width = layers[0][0].shape[1] + 1

    def fresh(lanes: int) -> _Lanes:
        return _Lanes(layers, moments, step, rate, batch_size, lanes)

    def together(lanes: list[np.ndarray]) -> np.ndarray:
        group = fresh(len(lanes))
        group.learn(lanes)
        return group.result()

    def lanes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for batch in batches:
            lanes, size, data = (batch.column(c) for c in ("lane", "size", "data"))
            lanes, size = lanes.to_numpy(), (8 * width * size.to_numpy()).tolist()
            for at, to in _runs(lanes):
                for i in range(at, to):
                    run = pa.decompress(data[i].as_buffer(), size[i], PACK_CODEC)
                    yield int(lanes[at]), np.frombuffer(run).reshape(-1, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 * len(moments[0]) + 4)
        held: list[np.ndarray] = []
        for _, pieces in groupby(lanes_of(batches), key=lambda piece: piece[0]):
            alone, some = None, []
            for _, rows in pieces:
                some.append(rows)
                if sum(map(len, some)) * 8 * width > GROUP_BYTES:
                    rows = np.concatenate(some)
                    whole = len(rows) - len(rows) % batch_size
                    if whole:
                        alone = alone or fresh(1)
                        alone.learn([rows[:whole]])
                    some = [rows[whole:]]
            if alone:
                if sum(map(len, some)):
                    alone.learn([np.concatenate(some)])
                total += alone.result()
                continue
            held.append(np.concatenate(some))
            if len(held) == GROUP_LANES or sum(map(len, held)) * 8 * width > GROUP_BYTES:
                total += together(held)
                held = []
        total += together(held) if held else 0
        slots = np.arange(len(total), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total)], ["slot", "total"])

    return run


def mlp_fit(
    df: DataFrame,
    feats: Sequence[str],
    label: str = "label",
    key: str = "id",
    hidden: Sequence[int] = tuple(NET_LAYERS[1:-1]),
    epochs: int = NET_EPOCHS,
    learning_rate: float = NET_LEARNING_RATE,
    batch_size: int = NET_BATCH_SIZE,
    lanes: int | None = None,
    seed: int = SEED,
    partitions: int | None = None,
) -> tuple[NetWeights, list[float]]:
    """Train with Adam on the cross-entropy; returns the weights and the loss per epoch.

    Rows are dealt by a hash of the key into ``lanes`` and ordered by it.  In an epoch every
    lane takes its rows once in batches of ``batch_size`` from the common weights on; then
    weights and moments are averaged, over the lanes of a task and over tasks, each lane
    counting by its rows.  One pass and one small result per task and epoch; a task trains its
    lanes side by side, and reads rows packed into runs.

    ``lanes`` belongs to the model like the seed.  Unless given it follows from the number of
    rows, ``LANE_ROWS`` to a lane, so lanes stay small and their number grows.  Files and
    ``partitions``, the tasks that share the lanes out, do not matter.  One lane is plain
    mini-batch training.
    """
    layers = NetWeights.random([len(feats), *hidden, 1], seed).layers
    size = len(_flatten(layers))
    moments = np.zeros(size), np.zeros(size)
    narrow = df.select(
        *[named(f).cast("double").alias(f"x{i}") for i, f in enumerate(feats)],
        named(label).cast("double").alias("label"),
        F.xxhash64(named(key), F.lit(seed)).alias("_hash"),
        named(key).alias("_key"),
    )
    n_rows = narrow.count() if lanes is None or partitions is None else 0
    lanes = lanes or max(1, ceil(n_rows / LANE_ROWS))
    cores = df.sparkSession.sparkContext.defaultParallelism
    partitions = partitions or min(lanes, max(cores, ceil(n_rows / TASK_ROWS)))
    lane = F.pmod("_hash", F.lit(lanes)).cast("int")
    inputs = [F.col(f"x{i}") for i in range(len(feats))]
    rows = (
        narrow.withColumn("_lane", lane)
        .repartition(partitions, "_lane")
        .sortWithinPartitions("_lane", "_hash", "_key")
        .select("_lane", *inputs, "label")
        .mapInArrow(_packed(len(inputs) + 1), "lane int, size int, data binary")
        # A pass reads every run once, so there is little to gain from a heap full of them.
        .persist(StorageLevel.DISK_ONLY)
    )
    losses, step = [], 0
    try:
        for _ in range(epochs):
            sums = (
                rows.mapInArrow(
                    _lane_epochs(layers, moments, step, learning_rate, batch_size),
                    "slot int, total double",
                )
                .repartition(SUM_TASKS, "slot")
                .groupBy("slot")
                .agg(F.sum("total").alias("total"))
            )
            total = np.zeros(3 * size + 4)
            for r in sums.collect():
                total[r["slot"]] = r["total"]
            loss, seen, steps, filled = total[-4:]
            if not seen:
                return NetWeights(layers), [float("nan")] * epochs
            losses.append(loss / seen)
            flat, *moments = (total[:-4] / seen).reshape(3, size)
            layers = _unflatten(flat, layers)
            step += max(1, round(steps / filled))
    finally:
        rows.unpersist()
    return NetWeights(layers), losses


def perceptron_fit(
    df: DataFrame,
    hidden: Sequence[int] = tuple(NET_LAYERS[1:-1]),
    epochs: int = NET_EPOCHS,
    seed: int = SEED,
) -> MultilayerPerceptronClassificationModel:
    """Built-in perceptron on ``features, label``: sigmoid hidden layers, softmax output."""
    width = len(df.select("features").first()["features"])
    return MultilayerPerceptronClassifier(
        layers=[width, *hidden, 2], maxIter=epochs, seed=seed
    ).fit(df)
