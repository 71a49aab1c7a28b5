"""Importance resampling towards a target: array-scored weights and an exact selection.

Features are runs of words, hashed into buckets by CRC-32.  Corpus and target are counted per
bucket; the logarithm of their smoothed ratio is a bucket's gain, and a document weighs the
mean gain of its features, looked up in one array.  Gumbel noise from a hash of the id turns
the highest weights into a draw without replacement.

The draw finds its cutoff key without sorting the corpus: every part gives the median of its
remaining keys, their median weighted by the parts' remaining sizes is the next pivot, and at
least an eighth of the keys lies on either side of it, so each pass discards a guaranteed
share.  Only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabstride.llm.components import stored
from tabstride.llm.hashing import BLOCK_BYTES, text_slices
from tabstride.operators.running import running_totals
from tabstride.session import broadcast_if_small


@dataclass(frozen=True)
class Resampling:
    """Words per feature, buckets, least words, percent drawn, seed; sizes of the selection.

    ``most_parts`` bounds the medians that reach the driver in a pass, ``chunk_rows`` the keys
    of which a task takes one median, and ``last_rows`` the keys that are sorted at the end.
    """

    shortest: int = 1
    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024
    most_parts: int = 1024
    chunk_rows: int = 1 << 20
    last_rows: int = 4096


# Bytes of a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Bytes of a feature whose CRC comes from the tables; a longer one goes through zlib.
_TABLED = 512


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """What a byte adds to the CRC when d bytes follow it, and the CRC of n zero bytes.

    CRC-32 is linear in the message but for its start value, which only the length brings in.
    """
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    adds = np.empty((_TABLED, 256), np.uint32)
    adds[0] = step
    for d in range(1, _TABLED):
        adds[d] = (adds[d - 1] >> np.uint32(8)) ^ step[adds[d - 1] & np.uint32(255)]
    zeros = np.array([zlib.crc32(bytes(n)) for n in range(_TABLED + 1)], np.uint32)
    return adds, zeros


class FeatureHasher:
    """Buckets of all features of some texts."""

    def __init__(self, rules: Resampling):
        self.rules = rules
        self.adds, self.zeros = _crc_tables()

    def crcs(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """CRC-32 of each segment of ``data``; none is empty."""
        out = np.zeros(len(starts), np.uint32)
        short = np.flatnonzero(lengths <= _TABLED)
        before = np.cumsum(lengths[short])
        for lo in range(0, int(before[-1]) if len(short) else 0, BLOCK_BYTES):
            some = short[slice(*np.searchsorted(before, [lo, lo + BLOCK_BYTES], "right"))]
            size = lengths[some]
            if not len(some):
                continue
            ends = np.cumsum(size)
            inside = np.arange(ends[-1]) - np.repeat(ends - size, size)
            units = data[np.repeat(starts[some], size) + inside]
            parts = self.adds[np.repeat(size, size) - 1 - inside, units]
            out[some] = np.bitwise_xor.reduceat(parts, ends - size) ^ self.zeros[size]
        for i in np.flatnonzero(lengths > _TABLED).tolist():
            out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]].tobytes())
        return out

    def buckets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets in the order of the texts, features per text, words per text."""
        rules, n = self.rules, len(offsets) - 1
        inside = np.concatenate([_WORD[_LOWER[data]], [False]])
        # The words' bytes with one blank behind each; a text's end ends a word as well.
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins = np.flatnonzero(inside & (edge | ~np.concatenate([[False], inside[:-1]])))
        stops = np.flatnonzero(
            np.concatenate([[False], inside[:-1]]) & (edge | ~inside)
        )
        sizes = stops - begins
        owner = np.searchsorted(offsets, begins, "right") - 1
        words = np.bincount(owner, minlength=n)
        if rules.longest == 1:
            found = self.crcs(_LOWER[data], begins, sizes) % rules.buckets
            return found, words, words
        # Words joined by blanks, so that a run of words is a segment.
        place = np.cumsum(sizes + 1) - sizes - 1
        joined = np.insert(_LOWER[data][inside[:-1]], np.cumsum(sizes), 32)
        counts = np.zeros(n, np.int64)
        owners, found = [], []
        for size in range(rules.shortest, rules.longest + 1):
            if len(begins) < size:
                continue
            first = np.flatnonzero(owner[: len(owner) - size + 1] == owner[size - 1 :])
            last = first + size - 1
            found.append(self.crcs(joined, place[first], place[last] + sizes[last] - place[first]))
            owners.append(owner[first])
            counts += np.bincount(owner[first], minlength=n)
        if not found:
            return np.zeros(0, np.int64), counts, words
        order = np.argsort(np.concatenate(owners), kind="stable")
        return np.concatenate(found)[order] % rules.buckets, counts, words

    def of_slices(
        self, batches: Iterator[pa.RecordBatch], column: int
    ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for part, data, offsets in text_slices(batches, column, BLOCK_BYTES):
            yield part, *self.buckets(data, offsets)


def _texts(df: DataFrame, *columns: Column, text_col: str) -> DataFrame:
    return df.select(*columns, F.col(text_col).cast("string").alias("_text"))


def bucket_counts(df: DataFrame, text_col: str = "text", rules: Resampling | None = None) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``buckets`` numbers in all."""
    rules = rules or Resampling()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = FeatureHasher(rules), np.zeros(rules.buckets, np.int64)
        for _, found, _, _ in hasher.of_slices(batches, 0):
            counts += np.bincount(found, minlength=rules.buckets)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(counts[filled])], ["bucket", "n"])

    sums = _texts(df, text_col=text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket")
    counts = np.zeros(rules.buckets, np.int64)
    for row in sums.agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` of each of B buckets, in doubles."""
    n = len(corpus)
    all_s, all_t = float(corpus.sum() + n), float(target.sum() + n)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def gumbel(key: str) -> int:
    """Noise of a key: ``floor(-1000 ln(-ln u))`` with u from the first 32 bits of its hash."""
    u = (int(hashlib.sha256(key.encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
    return math.floor(-1000 * math.log(-math.log(u)))


def score(
    df: DataFrame,
    gains: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Resampling | None = None,
) -> DataFrame:
    """Per row ``id, n_words, n_features, weight, score, place``.

    ``place`` tells every row from every other, equal ones too, once the result is stored.
    """
    rules = rules or Resampling()
    kind = dict(df.select(id_col).dtypes)[id_col]
    schema = f"`id` {kind}, n_words long, n_features long, weight long, score long, place long"
    narrow = _texts(df, F.col(id_col), F.col(id_col).cast("string").alias("_key"), text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, place = FeatureHasher(rules), TaskContext.get().partitionId() << 40
        for part, found, counts, words in hasher.of_slices(batches, 2):
            sums = np.zeros(len(counts), np.int64)
            some = counts > 0
            if some.any():
                sums[some] = np.add.reduceat(gains[found], (np.cumsum(counts) - counts)[some])
            weight = sums // np.maximum(counts, 1)
            noise = [gumbel(f"{rules.seed}:{'' if k is None else k}") for k in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(words.astype(np.int64)), pa.array(counts.astype(np.int64)),
                    pa.array(weight), pa.array(weight + np.array(noise, np.int64)),
                    pa.array(place + np.arange(len(counts))),
                ],
                ["id", "n_words", "n_features", "weight", "score", "place"],
            )
            place += len(counts)

    return narrow.mapInArrow(run, schema)


_ORDER = [("score", "descending"), ("id", "ascending"), ("place", "ascending")]


def _not_after(key: dict) -> Column:
    """Whether a row's key is this one or comes before it; a null id comes last."""
    same = F.col("id").eqNullSafe(F.lit(key["id"])) & (F.col("place") <= key["place"])
    smaller = F.col("id").isNotNull() if key["id"] is None else F.coalesce(
        F.col("id") < F.lit(key["id"]), F.lit(False)
    )
    return (F.col("score") > key["score"]) | ((F.col("score") == key["score"]) & (smaller | same))


def _weighted_median(keys: pa.Table, sizes: np.ndarray) -> int:
    """Row of the key at which half of the sizes lie before or at it."""
    order = pc.sort_indices(keys, sort_keys=_ORDER).to_numpy()
    running = np.cumsum(sizes[order])
    return int(order[np.searchsorted(running, (running[-1] + 1) // 2)])


def _medians(keys: DataFrame, rules: Resampling) -> list[dict]:
    """Per part and side of the last pivot: a median key and the number of keys.

    A part reads its keys chunk by chunk and gives the weighted median of the chunks' medians.
    """
    kind = dict(keys.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        medians: dict[bool, list[tuple[pa.Table, int]]] = {True: [], False: []}
        held: list[pa.RecordBatch] = []

        def fold() -> None:
            table = pa.Table.from_batches(held)
            for side in medians:
                some = table.filter(pc.equal(table["before"], side)).select(["score", "id", "place"])
                if some.num_rows:
                    middle = pc.sort_indices(some, sort_keys=_ORDER)[(some.num_rows - 1) // 2].as_py()
                    medians[side].append((some.slice(middle, 1).combine_chunks(), some.num_rows))
            held.clear()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= rules.chunk_rows:
                fold()
        if held:
            fold()
        for side, found in medians.items():
            if found:
                table = pa.concat_tables([t for t, _ in found])
                sizes = np.array([n for _, n in found], np.int64)
                row = table.slice(_weighted_median(table, sizes), 1).combine_chunks()
                for batch in row.to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array([side]), pa.array([int(sizes.sum())])],
                        ["score", "id", "place", "before", "n"],
                    )

    parts = keys.select("score", "id", "place", "before").coalesce(rules.most_parts)
    schema = f"score long, id {kind}, place long, before boolean, n long"
    return [r.asDict() for r in parts.mapInArrow(run, schema).collect()]


def cutoff_key(keys: DataFrame, wanted: int, rules: Resampling | None = None) -> dict:
    """The ``wanted``-th key of stored, distinct ``score, id, place`` in their order.

    Each pass reads the keys that remain between two pivots, counts them on both sides of the
    newest one and takes the medians for the next, so a pivot costs one pass.  The remaining
    keys are stored anew when they have become an eighth.
    """
    rules = rules or Resampling()
    keys = keys.select("score", "id", "place")
    kind = to_arrow_type(keys.schema["id"].dataType)
    pivot, bounds, size = None, F.lit(True), None
    while True:
        before = _not_after(pivot) if pivot else F.lit(True)
        found = _medians(keys.filter(bounds).withColumn("before", before), rules)
        if pivot:
            first = sum(r["n"] for r in found if r["before"])
            lower = wanted <= first
            wanted -= 0 if lower else first
            bounds = bounds & (before if lower else ~before)
            found = [r for r in found if r["before"] == lower]
        left = sum(r["n"] for r in found)
        if left <= rules.last_rows:
            # At most ``last_rows`` keys.
            rows = keys.filter(bounds).orderBy(F.desc("score"), F.asc_nulls_last("id"), "place")
            return rows.collect()[wanted - 1].asDict()
        size = size or left
        if 8 * left <= size:
            keys, bounds, size = stored(keys.filter(bounds), "keys"), F.lit(True), left
        table = pa.table({
            "score": pa.array([r["score"] for r in found], pa.int64()),
            "id": pa.array([r["id"] for r in found], kind),
            "place": pa.array([r["place"] for r in found], pa.int64()),
        })
        pivot = found[_weighted_median(table, np.array([r["n"] for r in found], np.int64))]


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    rules: Resampling | None = None,
) -> DataFrame:
    """Per row ``id, n_features, weight, score, rank``; ``rank`` is null unless drawn.

    Of the rows with at least ``least_words`` words, ``percent`` per hundred with the highest
    scores are drawn, ties to the smaller id.  A null or empty text has no features and weighs
    0; a null id has the noise of an empty id and comes last among equal scores; repeated rows
    are rows of their own with ranks of their own; an empty table, or an empty target, is one
    of zero counts.  Other columns are not read.
    """
    rules = rules or Resampling()
    gains = bucket_gains(
        bucket_counts(df, text_col, rules), bucket_counts(target, target_text_col, rules)
    )
    scored = stored(score(df, gains, id_col, text_col, rules), "scores")
    fit = F.col("n_words") >= rules.least_words
    wanted = rules.percent * scored.filter(fit).count() // 100
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    won = fit & _not_after(cutoff_key(scored.filter(fit), wanted, rules))
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("place")]
    parts = max(1, math.ceil(wanted / rules.chunk_rows))
    names = ["id", "n_features", "weight", "score"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scored.select(names).schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            nth = np.arange(at, at + batch.num_rows) + 1
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(nth)],
                [*names, "part", "nth"],
            )

    ranges = scored.filter(won).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    winners = stored(ranges.select(names).mapInArrow(number, f"{fields}, part int, nth long"), "winners")
    sizes = running_totals(
        winners.groupBy("part").agg(F.count("*").alias("n")), [F.col("part")], ["n"]
    ).select("part", (F.col("cum_n") - F.col("n")).alias("first"))
    ranked = winners.join(broadcast_if_small(sizes), "part").select(
        *columns, (F.col("first") + F.col("nth")).alias("rank")
    )
    others = scored.filter(~won).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(others)
