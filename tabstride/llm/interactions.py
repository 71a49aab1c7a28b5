"""Audit of how filters interact: what every order of them would remove.

A document's failures are a mask of one bit per filter.  Documents are counted by part and
mask, so an audit of any corpus starts from at most 2**n counts a part.  These counts become a
decision diagram: a node of a level asks one filter, its two edges lead to the documents that
pass and that fail it, equal nodes are one, and every node knows the counts below it.  Another
order of the filters is reached by swapping two adjacent levels, which rewrites the nodes of
these two levels only; a walk over all orders needs one swap an order.  The path on which all
filters pass gives the steps of an order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabstride.llm.hashing import per_text, text_slices, words
from tabstride.session import broadcast_if_small

# Counts that a node carries: documents, good ones, toxic ones.
Counts = tuple[int, int, int]


@dataclass(frozen=True)
class Filters:
    """Limits of the filters: words, distinct words, capitals, marks, copies."""

    names: str = "ABCDE"
    least_words: int = 100
    distinct_percent: int = 80
    capital_percent: int = 10
    marks: str = "#$%&*|"


class Diagram:
    """Count-weighted decision diagram over failure masks, with a level per filter.

    Nodes are numbers.  ``edges[node]`` holds the nodes for pass and fail, ``weight[node]`` the
    counts of all masks below it; ``unique`` finds a node by its level's filter and its edges.
    Levels are never skipped, so a node's weight is the sum over its edges.
    """

    def __init__(self, masks: dict[int, Counts], n_filters: int):
        self.order = list(range(n_filters))
        self.edges: list[tuple[int, int]] = []
        self.weight: list[Counts] = []
        self.unique: dict[tuple, int] = {}
        ends = [self._leaf(masks.get(mask, (0, 0, 0))) for mask in range(1 << n_filters)]
        # The last filter of the order is asked last: bit by bit from there.
        for name in reversed(range(n_filters)):
            half = 1 << name
            ends = [self._node(name, ends[m], ends[m + half]) for m in range(half)]
        self.root = ends[0]

    def _leaf(self, counts: Counts) -> int:
        return self._made(("leaf", counts), (-1, -1), counts)

    def _node(self, name: int, passed: int, failed: int) -> int:
        a, b = self.weight[passed], self.weight[failed]
        return self._made((name, passed, failed), (passed, failed), (a[0] + b[0], a[1] + b[1], a[2] + b[2]))

    def _made(self, key: tuple, edges: tuple[int, int], weight: Counts) -> int:
        node = self.unique.get(key)
        if node is None:
            node = self.unique[key] = len(self.edges)
            self.edges.append(edges)
            self.weight.append(weight)
        return node

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one.

        What a node of ``level`` stands for stays the same, so nodes above keep their edges.
        """
        upper, lower = self.order[level], self.order[level + 1]
        nodes = {self.root}
        for _ in range(level):
            nodes = {child for n in nodes for child in self.edges[n]}
        for n in nodes:
            passed, failed = self.edges[n]
            del self.unique[upper, passed, failed]
        for n in nodes:
            (pp, pf), (fp, ff) = (self.edges[e] for e in self.edges[n])
            self.edges[n] = (self._node(upper, pp, fp), self._node(upper, pf, ff))
            self.unique[lower, *self.edges[n]] = n
        self.order[level], self.order[level + 1] = lower, upper

    def all_pass_path(self) -> Iterator[tuple[int, Counts, Counts]]:
        """Per level: its filter, the counts it lets through and those it removes."""
        node = self.root
        for name in self.order:
            passed, failed = self.edges[node]
            yield name, self.weight[passed], self.weight[failed]
            node = passed

    def fails_only(self, name: int) -> int:
        """Documents that fail this filter and no other."""
        node = self.root
        for asked in self.order:
            node = self.edges[node][asked == name]
        return self.weight[node][0]


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap so that all orders of ``n`` filters come up, each once.

    Every order is the last one with two neighbours exchanged: the last item wanders through
    each order of the others, to and fro.
    """
    if n < 2:
        return
    inner = adjacent_swaps(n - 1)
    downward = True
    while True:
        yield from range(n - 2, -1, -1) if downward else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        # While the last item stands in front, the others are one place further back.
        yield step + 1 if downward else step
        downward = not downward


def audit_masks(masks: dict[int, Counts], names: str) -> list[tuple]:
    """``order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    diagram = Diagram(masks, len(names))
    fails = [sum(c[0] for m, c in masks.items() if m >> i & 1) for i in range(len(names))]
    alone = [diagram.fails_only(i) for i in range(len(names))]
    rows, removed_in_all = [], [0] * len(names)

    def read() -> None:
        order = "".join(names[i] for i in diagram.order)
        for step, (i, kept, removed) in enumerate(diagram.all_pass_path(), start=1):
            removed_in_all[i] += removed[0]
            rows.append(
                (order, step, kept[0], removed[0], fails[i] - removed[0], alone[i], removed[1], removed[2], i)
            )

    read()
    for level in adjacent_swaps(len(names)):
        diagram.swap(level)
        read()
    return [(*r[:-1], removed_in_all[r[-1]]) for r in rows]


def failure_masks(
    df: DataFrame, id_col: str, text_col: str, part_col: str, filters: Filters
) -> DataFrame:
    """``id, part, text_key, mask`` per row, without the filter on copies.

    Words are ``[^\\x20\\x09-\\x0D]+`` and case counts; ``text_key`` is a hash of the whole text.
    """
    kind = dict(df.select(id_col).dtypes)[id_col]
    marks, capitals, starts = np.zeros(256, bool), np.zeros(256, bool), np.ones(256, bool)
    marks[list(filters.marks.encode())] = True
    capitals[65:91] = True
    starts[0x80:0xC0] = False  # bytes that continue a code point

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, 2):
            found = words(data, offsets, lower=False)
            n = np.bincount(found.texts, minlength=part.num_rows)
            order = np.lexsort((found.hashes, found.texts))
            text, word = found.texts[order], found.hashes[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (word[1:] != word[:-1])
            distinct = np.bincount(text[new], minlength=part.num_rows)
            mask = (n < filters.least_words).astype(np.int32)
            mask |= (100 * distinct < filters.distinct_percent * n).astype(np.int32) << 1
            n_capitals, n_points = per_text(capitals[data], offsets), per_text(starts[data], offsets)
            mask |= (100 * n_capitals > filters.capital_percent * n_points).astype(np.int32) << 2
            mask |= (per_text(marks[data], offsets) > 0).astype(np.int32) << 3
            edges = offsets.tolist()
            keys = [
                hashlib.blake2b(data[a:b], digest_size=16).digest()
                for a, b in zip(edges[:-1], edges[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(keys, pa.binary()), pa.array(mask)],
                ["id", "part", "text_key", "mask"],
            )

    narrow = df.select(
        F.col(id_col), F.coalesce(F.col(part_col).cast("string"), F.lit("")),
        F.col(text_col).cast("string").alias("_text"),
    )
    return narrow.mapInArrow(run, f"id {kind}, part string, text_key binary, mask int")


def mask_counts(masked: DataFrame, marked: DataFrame, n_filters: int) -> DataFrame:
    """``part, mask, n, good, toxic`` with the filter on copies as the mask's last bit.

    ``masked`` has ``id, part, text_key, mask``; ``marked`` has ``id, good, toxic``, an id once.
    A row is a copy if a smaller id has its text.  Rows of one text are counted by part, good
    and toxic before they come together, so a text that stands in very many rows is a few rows.
    """
    single = masked.groupBy("text_key", "id", "part", "mask").agg(F.count("*").alias("n"))
    labelled = single.join(broadcast_if_small(marked), "id", "left").select(
        "text_key", "part", "mask", "n", F.struct(F.col("id").isNull(), F.col("id")).alias("at"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    combined = labelled.groupBy("text_key", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.struct("at", "n")).alias("least")
    )
    # One row per text, part and label: the smallest id of the text is in one of them.
    first = F.col("least.at") == F.min("least.at").over(Window.partitionBy("text_key"))
    passed = combined.withColumn("first", F.when(first, F.col("least.n")).otherwise(F.lit(0)))
    copy = 1 << (n_filters - 1)
    cells = F.array(
        F.struct(F.col("mask"), F.col("first").alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("first")).alias("n")),
    )
    counted = passed.select("part", "good", "toxic", F.inline(cells)).filter("n > 0")
    return counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


_COLUMNS: Sequence[str] = (
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
    "toxic_lost", "shapley",
)


def audit(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters and step, from ``part, mask, n, good, toxic``.

    Bit i of a mask belongs to ``names[i]``.  A part is one small group of at most 2**n rows.
    """

    def run(table: pa.Table) -> pa.Table:
        held = table.to_pydict()
        masks = {
            m: c for m, *c in zip(held["mask"], held["n"], held["good"], held["toxic"], strict=True)
        }
        rows = audit_masks({m: tuple(c) for m, c in masks.items()}, names)
        columns = list(zip(*rows, strict=True))
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
        arrays = [pa.array([held["part"][0]] * len(rows)), *map(pa.array, columns, kinds)]
        return pa.Table.from_arrays(arrays, list(_COLUMNS))

    schema = ", ".join(
        f"{c} {'string' if i < 2 else 'int' if i == 2 else 'long'}" for i, c in enumerate(_COLUMNS)
    )
    return counts.groupBy("part").applyInArrow(run, schema)


def filter_audit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    filters: Filters | None = None,
) -> DataFrame:
    """``part, filter_order, step, kept, removed, ...`` for all orders of five filters.

    A fails below ``least_words`` words, B with too few distinct words, C with too many
    capitals, D with any of ``marks``, E if a smaller id has the same text.  ``labels`` has
    ``id_col, quality, toxic``; a document is good (toxic) if a label of it says quality 1
    (toxic 1), and neither without a label.  A null text is empty, a null part the empty
    string; a null id has no label and comes after every other id; rows that repeat an id and
    its text are no copies of one another; a part without documents has no rows, so an empty
    table gives none.  Other columns are not read.
    """
    filters = filters or Filters()
    marked = labels.select(F.col(id_col).alias("id"), "quality", "toxic").filter("id IS NOT NULL")
    marked = marked.groupBy("id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    masked = failure_masks(df, id_col, text_col, part_col, filters)
    return audit(mask_counts(masked, marked, len(filters.names)), filters.names)
