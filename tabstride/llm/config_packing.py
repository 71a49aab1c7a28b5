"""Best-fit packing by a configuration linear program over the length histogram.

Texts are encoded once and cut only where a document is longer than a sequence.  The program
asks for the fewest sequences, each filled by a configuration (how many pieces of each
length), that hold the histogram.  Multiplicative weights solve it: every length has a price,
a knapsack over the sequence's places finds the configuration of the highest price, and the
lengths it serves become cheaper.  The fractional solution is rounded down, the histogram
that is left is solved again, and a last remainder goes best fit decreasing, by groups of
equal sequences.  The plan has a size that depends on the sequence length, not on the corpus.

Pieces find their place by number: the k-th piece of a length takes the k-th opening for it.
Numbers come from counts per task, so no length is ever gathered in one task.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabstride.llm.components import stored
from tabstride.llm.hashing import text_slices
from tabstride.llm.word_bpe import SLICE_BYTES, fast_encoder
from tabstride.session import broadcast_if_small


@dataclass(frozen=True)
class Program:
    """Sequence length, closing id, rounds of rounding, and the steps of a round.

    A step uses configurations ``around`` so many lengths, each for at most a share ``step`` of
    a length's demand; ``rate`` is how fast prices fall.
    """

    window: int = 2048
    end_id: int = 0
    rounds: int = 3
    steps: int = 40
    around: int = 512
    step: float = 0.5
    rate: float = 1.0


@dataclass
class Bin:
    """``copies`` equal sequences with ``counts[length]`` pieces each and ``free`` places."""

    counts: dict[int, int]
    copies: int
    free: int


def knapsack(lengths: np.ndarray, prices: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest total price within 0 to ``window`` places, and the number of its last length.

    An unbounded knapsack: every entry is one maximum over the lengths, which ascend.  A
    chosen number of -1 means that a place stays free.
    """
    best, chosen = np.zeros(window + 1), np.full(window + 1, -1)
    usable = np.searchsorted(lengths, np.arange(window + 1), "right")
    for w in range(int(lengths[0]), window + 1):
        worth = prices[: usable[w]] + best[w - lengths[: usable[w]]]
        n = int(worth.argmax())
        if worth[n] > best[w - 1]:
            best[w], chosen[w] = worth[n], n
        else:
            best[w] = best[w - 1]
    return best, chosen


def configuration(first: int, lengths: np.ndarray, chosen: np.ndarray, window: int) -> dict[int, int]:
    """Counts per length of the best configuration that holds a piece of length ``first``."""
    counts, w = {first: 1}, window - first
    while w >= lengths[0]:
        if chosen[w] < 0:
            w -= 1
            continue
        length = int(lengths[chosen[w]])
        counts[length] = counts.get(length, 0) + 1
        w -= length
    return counts


def fractional_solution(histogram: dict[int, int], rules: Program) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often each is used, by multiplicative weights.

    Longer pieces start at the higher prices.  A step solves one knapsack and uses the best
    configurations around several lengths, each as often as a share of its scarcest length
    allows; a length served by a share s of its demand gets cheaper by ``exp(-rate * s)``, and
    one that is served in full drops out.
    """
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[n] for n in lengths.tolist()], np.float64)
    place = {n: i for i, n in enumerate(lengths.tolist())}
    prices = lengths * (1 + lengths / rules.window)
    served = np.zeros(len(lengths))
    used: list[tuple[dict[int, int], float]] = []
    for _ in range(rules.steps):
        wanted = np.flatnonzero(served < 1 - 1e-9)
        if not len(wanted):
            break
        best, chosen = knapsack(lengths[wanted], prices[wanted], rules.window)
        worth = prices[wanted] + best[rules.window - lengths[wanted]]
        for first in wanted[np.argsort(-worth, kind="stable")[: rules.around]].tolist():
            counts = configuration(int(lengths[first]), lengths[wanted], chosen, rules.window)
            at = np.array([place[n] for n in counts])
            share = np.array(list(counts.values())) / demand[at]
            times = min(rules.step / share.max(), ((1 - served[at]) / share).min())
            if times > 1e-9:
                used.append((counts, times))
                served[at] += share * times
                prices[at] *= np.exp(-rules.rate * share * times)
    return used


def best_fit_groups(histogram: dict[int, int], window: int) -> list[Bin]:
    """Best fit decreasing over equal pieces and equal sequences at once.

    The longest pieces go first, into the sequences with the least room that still holds them.
    """
    by_room: dict[int, list[Bin]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = min((r for r, bins in by_room.items() if r >= length and bins), default=None)
            if room is None:
                each = window // length
                group = Bin({}, -(-left // each), window)
            else:
                group = by_room[room].pop()
            each = group.free // length
            full = min(group.copies, left // each)
            rest = [(full, each), (1, left - full * each)] if full < group.copies else [(full, each)]
            taken = 0
            for copies, n in rest:
                if copies and n:
                    counts = group.counts | {length: group.counts.get(length, 0) + n}
                    made = Bin(counts, copies, group.free - n * length)
                    by_room.setdefault(made.free, []).append(made)
                    taken, left = taken + copies, left - copies * n
            if taken < group.copies and group.counts:
                by_room.setdefault(group.free, []).append(
                    Bin(group.counts, group.copies - taken, group.free)
                )
    return [b for bins in by_room.values() for b in bins]


def plan(histogram: dict[int, int], rules: Program) -> list[Bin]:
    """Sequences that hold exactly the pieces of the histogram (lengths 1 to ``window``)."""
    left = {n: c for n, c in histogram.items() if c}
    bins = []
    if full := left.pop(rules.window, 0):
        bins.append(Bin({rules.window: full}, full, 0))
        bins[-1].counts = {rules.window: 1}
    for _ in range(rules.rounds):
        if not left:
            break
        solution = fractional_solution(left, rules)
        placed = 0
        for counts, times in sorted(solution, key=lambda c: -c[1]):
            # Below one: taken once if it leaves no place free and its pieces are still there.
            full = sum(n * k for n, k in counts.items()) == rules.window
            copies = max(math.floor(times + 1e-9), int(full))
            copies = min(copies, *(left.get(n, 0) // k for n, k in counts.items()))
            if copies > 0:
                for n, k in counts.items():
                    left[n] -= k * copies
                bins.append(Bin(counts, copies, rules.window - sum(n * k for n, k in counts.items())))
                placed += copies
        left = {n: c for n, c in left.items() if c}
        if not placed:
            break
    return bins + best_fit_groups(left, rules.window)


@dataclass(frozen=True)
class Openings:
    """The plan by length: openings ``key`` on (length and number), and where they lead."""

    key: np.ndarray
    number: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    length: np.ndarray

    @staticmethod
    def of(bins: list[Bin]) -> Openings:
        rows, taken, sequence = [], {}, 0
        for b in bins:
            offset = 0
            for length, n in sorted(b.counts.items(), reverse=True):
                first = taken.get(length, 0)
                rows.append((length << 44 | first, first, n, sequence, offset, length))
                taken[length] = first + n * b.copies
                offset += n * length
            sequence += b.copies
        return Openings(*np.array(sorted(rows), np.int64).reshape(-1, 6).T.copy())

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``number``-th piece of each length."""
        at = np.searchsorted(self.key, length << 44 | number, "right") - 1
        inside = number - self.number[at]
        return (
            self.sequence[at] + inside // self.each[at],
            self.offset[at] + inside % self.each[at] * self.length[at],
        )


def _pieces(
    df: DataFrame, path: str, id_col: str, text_col: str, rules: Program, with_ids: bool
) -> DataFrame:
    """``id, piece, start, length, ids_crc32, ids, task, nth``: the nth of its length in a task."""
    kind = dict(df.select(id_col).dtypes)[id_col]
    schema = (
        f"id {kind}, piece int, start long, length long, ids_crc32 long, ids binary, task int, nth long"
    )
    names = ["id", "piece", "start", "length", "ids_crc32", "ids", "task", "nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = fast_encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(rules.window + 1, np.int64)
        closing = np.array([rules.end_id], np.int32)
        for part, _, _ in text_slices(batches, 1, SLICE_BYTES):
            owner, start, length, crc, data = [], [], [], [], []
            for row, ids in enumerate(encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                ids = np.concatenate([ids, closing])
                for at in range(0, len(ids), rules.window):
                    cut = ids[at : at + rules.window].astype("<u4").tobytes()
                    owner.append(row)
                    start.append(at)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
                    data.append(cut if with_ids else None)
            sizes = np.array(length, np.int64)
            order = np.argsort(sizes, kind="stable")
            nth = np.empty(len(sizes), np.int64)
            first = np.searchsorted(sizes[order], sizes[order])
            nth[order] = np.arange(len(sizes)) - first + seen[sizes[order]]
            seen += np.bincount(sizes, minlength=rules.window + 1)
            begin = np.array(start, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(owner, pa.int64())),
                    pa.array((begin // rules.window).astype(np.int32)), pa.array(begin),
                    pa.array(sizes), pa.array(crc, pa.int64()), pa.array(data, pa.binary()),
                    pa.array(np.full(len(sizes), task, np.int32)), pa.array(nth),
                ],
                names,
            )

    narrow = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return narrow.mapInArrow(run, schema)


def pack_best_fit(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: Program | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents in as few sequences as the program finds.

    Returns ``id, piece int, start, length, ids_crc32, sequence_id, offset`` (long) and, on
    request, ``ids`` (little-endian unsigned 32-bit).  A document is cut only into pieces of
    ``window`` ids, the last one shorter.  A null or empty text is its closing id alone; a
    null id stays null; repeated rows are documents of their own; pieces of one length are
    told apart by task and place, so any of them may be frequent.  An empty table has no
    pieces.  Other columns are not read.
    """
    rules = rules or Program()
    pieces = stored(_pieces(df, path, id_col, text_col, rules, with_ids), "pieces")
    counts = stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "length_counts")
    # At most as many rows as a sequence has places.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    openings = df.sparkSession.sparkContext.broadcast(Openings.of(plan(histogram, rules)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = pieces.join(broadcast_if_small(firsts), ["length", "task"]).select(
        "id", "piece", "start", "length", "ids_crc32", "ids",
        (F.col("first") + F.col("nth")).alias("number"),
    )
    kind = dict(df.select(id_col).dtypes)[id_col]
    schema = (
        f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long, ids binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("number").to_numpy()
            sequence, offset = openings.value.place(batch.column("length").to_numpy(), number)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset), batch.column("ids")],
                [id_col, *batch.schema.names[1:5], "sequence_id", "offset", "ids"],
            )

    placed = numbered.mapInArrow(run, schema)
    return placed if with_ids else placed.drop("ids")
