"""Substring dedup over sliding runs of sentences.

A text is cut into sentences; every run of several consecutive ones is hashed.  A run found
more than once keeps its first place (smallest id, then earliest sentence), and all sentences
that another occurrence covers are removed.  Runs are hashed in numpy; a grouped count of the
hashes leaves the few that repeat, and only their runs are gathered, compared and brought back
to the documents.  Joins on a hash have plain shuffles on both sides, so a frequent passage is
split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabstride.llm.components import stored
from tabstride.llm.hashing import _BASE, _LOWER, Words, mix, segment_hashes, text_slices, words


def _flags(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_ENDS, _PAUSES, _CLOSERS = _flags(b".!?"), _flags(b",;:"), _flags(b"\"')]}")


@dataclass(frozen=True)
class SpanRules:
    """A run has at least ``sentences`` sentences and ``words`` words.

    A sentence ends at a word with ``. ! ?`` (closing quotes and brackets may follow), at a
    line break and at the end of the text.  One of more than ``long_words`` words is cut at
    its commas, semicolons and colons as well, and after each word whose hash is a multiple of
    ``cut_every``, so that a passage in a sentence without pauses has cuts of its own.

    The shortest run from each sentence on is hashed; with ``both_ways`` also the shortest run
    that ends at each sentence.  Both together cover what all runs cover: a sentence behind the
    first shortest run of a repeated passage ends a run that begins in the passage.

    With ``window`` a long sentence is cut, in place of ``cut_every``, after each word whose
    hash is the least (the last of equal ones) of any ``window`` words of the sentence that
    follow one another, so that there is a cut in each such window, the same wherever the words
    stand.  With ``wrapped`` runs are also hashed over sentences that end at empty lines but not
    at other line breaks, so that lines of another width do not matter.  With ``characters``
    each character of a script without blanks counts as a word, and its marks end sentences.
    """

    sentences: int = 2
    words: int = 12
    long_words: int = 12
    cut_every: int = 8
    both_ways: bool = True
    window: int = 8
    wrapped: bool = True
    characters: bool = True


# Rules that miss no run: the default, and those of the queries.
WHOLE = SpanRules()


@dataclass
class Sentences:
    """Sentences of some texts: text, first byte, first word; and the words' count and hashes.

    With wrapped lines, ``by_line`` and ``joined`` say which of them begin a sentence if line
    breaks count and if they do not.
    """

    texts: np.ndarray
    starts: np.ndarray
    first_words: np.ndarray
    n_words: int
    hashes: np.ndarray
    by_line: np.ndarray | None = None
    joined: np.ndarray | None = None


# Scripts without blanks between words, first and last code point; their end marks, pauses and
# closing marks.  Fixed values.
_UNSPACED = np.array([
    (0x0E00, 0x0EFF), (0x0F00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF),
    (0x2E80, 0x312F), (0x3190, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
    (0xFE30, 0xFE4F), (0xFF00, 0xFF9F), (0xFFE0, 0xFFEF), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
])
_WIDE_ENDS = np.array(sorted(map(ord, "。！？．｡។៕။།༎")))
_WIDE_PAUSES = np.array(sorted(map(ord, "、，；：､၊៖")))
_WIDE_CLOSERS = np.array(sorted(map(ord, "」』）】》〉〕］｝｣〟")))


def _one_of(points: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return marks[np.minimum(np.searchsorted(marks, points), len(marks) - 1)] == points


def _split_characters(data: np.ndarray, found: Words) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words with each character of ``_UNSPACED`` on its own; whether one ends or pauses a sentence.

    Marks stay with what is before them.
    """
    none = np.zeros(len(found.hashes), bool)
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead):
        return found, none, none
    four = data[lead] >= 0xF0
    bits = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 63 for k in range(4)]
    points = (bits[0] & 15) << 12 | bits[1] << 6 | bits[2]
    points = np.where(four, (points & 0x7FFF) << 6 | bits[3], points)
    inside = np.searchsorted(_UNSPACED[:, 0], points, "right") - 1
    inside = (inside >= 0) & (points <= _UNSPACED[np.maximum(inside, 0), 1])
    ends, pauses, closers = (_one_of(points, m) for m in (_WIDE_ENDS, _WIDE_PAUSES, _WIDE_CLOSERS))
    after = lead + 3 + four
    marks = ends | pauses | closers
    if not inside.any():
        return found, none, none
    # Breaks in front of and behind each such character, but not in front of a mark.
    cuts = np.union1d(lead[inside], after[inside])
    cuts = cuts[~np.isin(cuts, lead[marks])]
    owner = np.searchsorted(found.starts, cuts, "right") - 1
    cuts = cuts[(owner >= 0) & (cuts < (found.starts + found.lengths)[owner])]
    starts = np.union1d(found.starts, cuts)
    owner = np.searchsorted(found.starts, starts, "right") - 1
    stops = np.minimum(np.r_[starts[1:], len(data)], (found.starts + found.lengths)[owner])
    lengths = stops - starts
    whole = found.lengths[owner] == lengths
    hashes = found.hashes[owner].copy()
    parts = np.flatnonzero(~whole)
    if len(parts):
        size = lengths[parts]
        place = np.arange(size.sum()) + np.repeat(starts[parts] - np.cumsum(size) + size, size)
        hashes[parts] = segment_hashes(_LOWER[data[place]], size)
    split = Words(hashes, starts, lengths, found.texts[owner])

    def words_with(at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), bool)
        own = np.searchsorted(starts, at, "right") - 1
        out[own[own >= 0]] = True
        return out

    return split, words_with(lead[ends]), words_with(lead[pauses])


def _least_in_windows(hashes: np.ndarray, sentence: np.ndarray, window: int) -> np.ndarray:
    """Words that are the last least one of some ``window`` words in a row of their sentence."""
    n = len(hashes)
    reach = np.ones(n, np.int16)
    for step, beats in ((-1, np.less_equal), (1, np.less)):
        going = np.ones(n, bool)
        for d in range(1, min(window, n)):
            here, there = (slice(d, n), slice(0, n - d)) if step < 0 else (slice(0, n - d), slice(d, n))
            fits = np.zeros(n, bool)
            fits[here] = (sentence[here] == sentence[there]) & beats(hashes[here], hashes[there])
            going &= fits
            reach += going
    return reach >= window


def _finals(final, pauses, hashes, rules: SpanRules) -> np.ndarray:
    """Last words of sentences, once the long ones are cut."""
    lengths = np.diff(np.r_[0, np.flatnonzero(final) + 1])
    long = np.repeat(lengths > rules.long_words, lengths)
    cuts = pauses.copy()
    if rules.window:
        at = np.flatnonzero(long)
        sentence = np.repeat(np.arange(len(lengths)), lengths)[at]
        cuts[at] |= _least_in_windows(hashes[at], sentence, rules.window)
    else:
        cuts |= hashes % np.uint64(rules.cut_every) == 0
    return final | long & cuts


def cut_sentences(data: np.ndarray, offsets: np.ndarray, rules: SpanRules) -> Sentences:
    found = words(data, offsets, lower=True)
    none = np.zeros(0, np.int64)
    if not len(found.hashes):
        return Sentences(none, none, none, 0, found.hashes)
    wide_ends = wide_pauses = False
    if rules.characters:
        found, wide_ends, wide_pauses = _split_characters(data, found)
    size = len(found.hashes)
    ends = found.starts + found.lengths
    last = ends - 1
    for _ in range(3):
        last -= _CLOSERS[data[last]] & (last > found.starts)
    last_of_text = np.r_[found.texts[1:] != found.texts[:-1], True]
    breaks = np.flatnonzero(data == 10)
    lines = np.searchsorted(breaks, np.r_[found.starts[1:], len(data)]) - np.searchsorted(breaks, ends)
    end = _ENDS[data[last]] | wide_ends | last_of_text
    pauses = _PAUSES[data[last]] | wide_pauses
    final = _finals(end | (lines > 0), pauses, found.hashes, rules)
    joined = None
    if rules.wrapped:
        joined = _finals(end | (lines > 1), pauses, found.hashes, rules)
        final, by_line = final | joined, final
    first = np.r_[0, np.flatnonzero(final)[:-1] + 1]
    s = Sentences(found.texts[first], found.starts[first], first, size, found.hashes)
    if joined is not None:
        s.by_line, s.joined = (np.r_[True, f[first[1:] - 1]] for f in (by_line, joined))
    return s


def hash_runs(s: Sentences, rules: SpanRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First sentence, number of sentences and hash of the shortest runs."""
    if s.joined is None:
        begin, end = _shortest_runs(s.texts, np.r_[s.first_words, s.n_words], rules)
    else:
        both = []
        for starts in (s.by_line, s.joined):
            own = np.r_[np.flatnonzero(starts), len(s.texts)]
            if len(s.texts):
                a, b = _shortest_runs(s.texts[own[:-1]], np.r_[s.first_words, s.n_words][own], rules)
                both.append(own[a] << 32 | own[b])
        pairs = np.unique(np.concatenate(both)) if both else np.zeros(0, np.int64)
        begin, end = pairs >> 32, pairs & 0xFFFFFFFF
    edges = np.r_[s.first_words, s.n_words]
    powers = np.full(s.n_words + 1, _BASE, np.uint64)
    inverse = np.full(s.n_words + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(s.hashes * powers[:-1])]
    a, b = edges[begin], edges[end]
    return begin, end - begin, mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))


def _shortest_runs(texts: np.ndarray, edges: np.ndarray, rules: SpanRules) -> tuple[np.ndarray, np.ndarray]:
    """First sentence of each run, and the one behind its last; ``edges`` has the first words and the end."""
    n = len(texts)
    begin = np.arange(n)
    end = np.searchsorted(edges, edges[:-1] + rules.words)
    end = np.maximum(end, begin + rules.sentences)
    fits = (end <= n) & (texts[np.minimum(end, n) - 1] == texts) if n else np.zeros(0, bool)
    if rules.both_ways and n:
        last = begin + 1
        back = np.searchsorted(edges, edges[1:] - rules.words, "right") - 1
        back = np.minimum(back, last - rules.sentences)
        more = (back >= 0) & (texts[back] == texts) & (end[back] != last)
        return np.r_[begin[fits], back[more]], np.r_[end[fits], last[more]]
    return begin[fits], end[fits]


def _run_table(df: DataFrame, id_col: str, text_col: str, rules: SpanRules) -> DataFrame:
    """``h, id, k, run`` per run: its hash, the text's id and hash, and ``i * 2**32 + n``."""
    kind = dict(df.select(id_col).dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, 2):
            s = cut_sentences(data, offsets, rules)
            begin, count, hashes = hash_runs(s, rules)
            owner = s.texts[begin]
            place = begin - np.searchsorted(s.texts, owner)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)),
                    part.column(0).take(pa.array(owner)),
                    part.column(1).take(pa.array(owner)),
                    pa.array(place << 32 | count),
                ],
                ["h", "id", "k", "run"],
            )

    text = F.col(text_col).cast("string")
    narrow = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k"), text.alias("text"))
    return narrow.mapInArrow(run, f"h long, id {kind}, k long, run long")


def repeated_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: SpanRules | None = None
) -> DataFrame:
    """``id, k, runs``: per text the runs that stand somewhere else before."""
    runs = _run_table(df, id_col, text_col, rules or SpanRules())
    often = stored(runs.groupBy("h").count().filter("count > 1").select("h"), "often")
    repeats = stored(runs.join(often, "h"), "repeats")
    place = F.struct("id", "k", "run")
    firsts = stored(repeats.groupBy("h").agg(F.min(place).alias("first")), "firsts")
    later = repeats.join(firsts, "h").filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "k").agg(F.collect_set("run").alias("runs"))


def drop_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: SpanRules | None = None
) -> DataFrame:
    """All rows and columns, with ``text`` free of covered sentences, and ``n_removed`` long.

    Removed sentences take the white space behind them along; white space at the end of the
    rest is trimmed if something was removed.  A null text stays null, a text that is covered
    as a whole becomes empty.  Rows with equal id and text count as one document: they do not
    repeat each other and get the same result.  A column named ``n_removed`` is replaced.
    """
    rules = rules or SpanRules()
    marks = repeated_runs(df, id_col, text_col, rules).select(
        F.col("id").alias("_tabstride_id"), F.col("k").alias("_tabstride_k"), F.col("runs").alias("_tabstride_runs")
    )
    source = df.drop("n_removed")
    text = F.col(text_col).cast("string")
    keyed = source.withColumn("_tabstride_key", F.xxhash64(text))
    marked = keyed.join(
        marks, (keyed["_tabstride_key"] == marks["_tabstride_k"]) & keyed[id_col].eqNullSafe(marks["_tabstride_id"]), "left"
    ).select(*[F.col(f"`{c}`") for c in source.columns], "_tabstride_runs")
    at, last = source.columns.index(text_col), len(source.columns)
    schema = T.StructType([
        *[T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType) for f in source.schema],
        T.StructField("n_removed", T.LongType()),
    ])

    def rewrite(data: np.ndarray, runs: list[int]) -> tuple[str, int]:
        s = cut_sentences(data, np.array([0, len(data)]), rules)
        first, count = np.array(runs, np.int64) >> 32, np.array(runs, np.int64) & 0xFFFFFFFF
        edges = np.zeros(len(s.texts) + 1, np.int64)
        np.add.at(edges, first, 1)
        np.add.at(edges, first + count, -1)
        covered = np.cumsum(edges[:-1]) > 0
        drop = np.zeros(len(data) + 1, np.int64)
        begin, end = s.starts, np.r_[s.starts[1:], len(data)]
        np.add.at(drop, begin[covered], 1)
        np.add.at(drop, end[covered], -1)
        kept = data[np.cumsum(drop[:-1]) == 0].tobytes().decode()
        return kept.rstrip(" \t\n\x0b\x0c\r"), int(covered.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, at):
            texts, removed = part.column(at), np.zeros(part.num_rows, np.int64)
            runs = part.column(last)
            marked_rows = np.flatnonzero(np.asarray(runs.is_valid()))
            if len(marked_rows):
                values = texts.to_pylist()
                for row in marked_rows.tolist():
                    body = data[offsets[row] : offsets[row + 1]]
                    values[row], removed[row] = rewrite(body, runs[row].as_py())
                texts = pa.array(values, pa.string())
            columns = [texts if c == at else part.column(c) for c in range(last)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed)], schema.names)

    return marked.withColumn(text_col, text).mapInArrow(run, schema)
