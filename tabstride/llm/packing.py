"""Lexical retrieval packing: fixed windows filled with documents that share rare words.

Documents are dealt into ordered ranges of about equal text size, so a frequent source is
split over many tasks.  Within a source they are ordered by a signature of their words, the
least word hash: two documents have it in common with the chance of their words' similarity,
so like documents come into the same range at any size of the corpus.  A task reads its range in shards of a bounded number of ids.  In a
shard a BM25 inverted index over the ids gives the unused neighbours of each seed document,
which fill the seed's window greedily; the last one is cut to size.  Whatever does not fill a
window moves on to the next shard, so only the last window of a range has padding.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstride.llm.hashing import text_slices
from tabstride.llm.word_bpe import SLICE_BYTES, TextEncoder, fast_encoder

_K1, _B = 1.2, 0.75


@dataclass(frozen=True)
class Packing:
    """Sizes: window in ids, text per task, a shard's ids and documents, words per query."""

    window: int = 2048
    end_id: int = 1
    task_chars: int = 8_000_000
    most_tasks: int = 20_000
    shard_ids: int = 1_000_000
    shard_docs: int = 8_192
    query_terms: int = 24
    neighbours: int = 48


@dataclass
class Piece:
    """The tail of a document: ids from place ``base`` on, of which the first ``at`` are placed."""

    key: object
    ids: np.ndarray
    base: int
    total: int
    at: int = 0

    @property
    def words(self) -> np.ndarray:
        """Ids not yet placed, without the closing one."""
        return self.ids[self.at : -1]


class Bm25Index:
    """Inverted index of a shard: postings with their BM25 weights, by term."""

    def __init__(self, docs: Sequence[np.ndarray], n_terms: int):
        lengths = np.array([len(d) for d in docs], np.int64)
        owner = np.repeat(np.arange(len(docs), dtype=np.int64), lengths)
        terms = np.concatenate(docs).astype(np.int64) if len(docs) else owner
        pairs, counts = np.unique(terms * len(docs) + owner, return_counts=True)
        self.docs = pairs % len(docs)
        term = pairs // len(docs)
        self.edges = np.searchsorted(term, np.arange(n_terms + 1))
        found = np.diff(self.edges)
        self.idf = np.log1p((len(docs) - found + 0.5) / (found + 0.5))
        norm = _K1 * (1 - _B + _B * lengths / max(lengths.mean(), 1))
        self.weights = self.idf[term] * counts * (_K1 + 1) / (counts + norm[self.docs])
        self.size = len(docs)

    def neighbours(self, query: np.ndarray, usable: np.ndarray, rules: Packing) -> list[int]:
        """Usable documents with the highest scores for the rarest terms of the query."""
        terms = np.unique(query)
        most = rules.query_terms
        if len(terms) > most:
            terms = terms[np.argpartition(-self.idf[terms], most)[:most]]
        lo, sizes = self.edges[terms], self.edges[terms + 1] - self.edges[terms]
        ends = np.cumsum(sizes)
        at = np.repeat(lo - (ends - sizes), sizes) + np.arange(ends[-1])
        scores = np.bincount(self.docs[at], self.weights[at], self.size) * usable
        most = min(rules.neighbours, self.size)
        best = np.argpartition(-scores, most - 1)[:most]
        best = best[np.lexsort((best, -scores[best]))]
        return best[scores[best] > 0].tolist()


def pack_shard(
    pieces: list[Piece], n_terms: int, rules: Packing
) -> Iterator[list[tuple[Piece, int, int]]]:
    """Windows as lists of ``piece, at, length``; the last list may be short of a window."""
    index = Bm25Index([p.words for p in pieces], n_terms)
    unused = np.array([len(p.ids) - p.at for p in pieces], np.int64)
    seed, window, room = 0, [], rules.window

    def place(n: int) -> None:
        nonlocal room
        piece, length = pieces[n], min(int(unused[n]), room)
        window.append((piece, piece.at, length))
        piece.at += length
        unused[n] -= length
        room -= length

    while True:
        while seed < len(pieces) and not unused[seed]:
            seed += 1
        if seed == len(pieces):
            break
        query = pieces[seed].words
        place(seed)
        if room and len(query):
            best = index.neighbours(query, unused > 0, rules)
            for n in best:
                if room >= unused[n]:
                    place(n)
            for n in best:
                if room and unused[n]:
                    place(n)
        if not room:
            yield window
            window, room = [], rules.window
    yield window


class _RangePacker:
    """Packs the documents of one task; finished pieces gather in ``keys`` and ``rows``."""

    def __init__(self, encoder: TextEncoder, rules: Packing, first_sequence: int, with_ids: bool):
        self.encoder, self.rules, self.with_ids = encoder, rules, with_ids
        self.sequence = first_sequence
        self.n_terms = rules.end_id + 1
        self.pool: list[Piece] = []
        self.pooled = 0
        self.keys: list[object] = []
        self.rows: list[tuple] = []

    def add(self, keys: list[object], texts: list[str]) -> None:
        closing = np.array([self.rules.end_id], np.int32)
        window = self.rules.window
        for key, ids in zip(keys, self.encoder.encode(texts), strict=True):
            ids = np.concatenate([ids, closing])
            self.n_terms = max(self.n_terms, int(ids.max()) + 1)
            whole = len(ids) - len(ids) % window
            for start in range(0, whole, window):
                self._emit([(Piece(key, ids, 0, len(ids)), start, window)])
            if whole < len(ids):
                self.pool.append(Piece(key, ids[whole:].copy(), whole, len(ids)))
                self.pooled += len(ids) - whole
        if self.pooled >= self.rules.shard_ids or len(self.pool) >= self.rules.shard_docs:
            self._pack()

    def finish(self) -> None:
        if self.pool:
            self._pack()
        if self.pool:
            self._emit([(p, p.at, len(p.ids) - p.at) for p in self.pool])

    def _pack(self) -> None:
        """Pack the pool; what does not fill a window opens the next shard."""
        rest: list[tuple[Piece, int, int]] = []
        for window in pack_shard(self.pool, self.n_terms, self.rules):
            if sum(length for _, _, length in window) == self.rules.window:
                self._emit(window)
            else:
                rest = window
        for piece, at, _ in rest:
            piece.at = at
        self.pool = [piece for piece, _, _ in rest]
        self.pooled = sum(length for _, _, length in rest)

    def _emit(self, window: Sequence[tuple[Piece, int, int]]) -> None:
        offset = 0
        for piece, at, length in window:
            data = piece.ids[at : at + length].astype("<u4").tobytes()
            self.keys.append(piece.key)
            self.rows.append((piece.base + at, length, zlib.crc32(data), piece.total,
                              self.sequence, offset, data if self.with_ids else None))
            offset += length
        self.sequence += 1


def pack(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    locality: Sequence[str] = (),
    rules: Packing | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most ``window`` ids.

    Returns ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (long) and, on
    request, ``ids`` (little-endian unsigned 32-bit).  Documents with equal ``locality``
    columns come into the same ranges.  A null or empty text is its closing id alone; a null
    id stays null; repeated rows are documents of their own, dealt over as many ranges as they
    need only where id or text differ; an empty table has no pieces.  Other columns are not read.
    """
    rules = rules or Packing()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    chars = df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    tasks = min(max(1, math.ceil(chars / rules.task_chars)), rules.most_tasks)
    # Hashed once more: the least of many hashes is small, which would order by length.
    word_hashes = F.transform(F.split(F.lower(text), " "), lambda w: F.xxhash64(w))
    near = [F.col(c).alias(f"_near{i}") for i, c in enumerate(locality)]
    order = [f"_near{i}" for i in range(len(near))]
    ranged = (
        df.select(
            F.col(id_col), text.alias("_text"), *near, F.xxhash64(F.array_min(word_hashes)).alias("_like"),
            F.xxhash64(id_col, text).alias("_dealt"),
        )
        .repartitionByRange(tasks, *order, "_like", "_dealt")
        .sortWithinPartitions(*order, "_like", "_dealt", "_text")
    )
    kind = dict(df.select(id_col).dtypes)[id_col]
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"`{id_col}` {kind}, {', '.join(f'{n} long' for n in names)}, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _RangePacker(
            fast_encoder(path), rules, TaskContext.get().partitionId() << 40, with_ids
        )
        key_type = None

        def pieces() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) or [[]] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns[:6]]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(packer.keys, key_type), *arrays, pa.array(columns[6], pa.binary())],
                [id_col, *names, "ids"],
            )
            packer.keys, packer.rows = [], []
            return batch

        for part, _, _ in text_slices(batches, 1, SLICE_BYTES):
            key_type = part.column(0).type
            packer.add(part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()])
            if len(packer.rows) >= 2_000:
                yield pieces()
        packer.finish()
        if packer.rows:
            yield pieces()

    packed = ranged.mapInArrow(run, schema)
    return packed if with_ids else packed.drop("ids")
