"""Quality rules: how much of a text repeats, measured in characters.

Rolling hashes of several word-run lengths and hashes of lines are taken in numpy over whole
Arrow batches; nothing is shuffled.  A null or empty text has no word and fails the base rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstride.llm import hashing

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SALT = np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class QualityRules:
    """Limits of the verdict, in percent.

    ``covered`` holds pairs of a run length and the largest share of word characters that may
    lie in runs of so many words which repeat an earlier run of the text; ``dup_lines`` and
    ``dup_line_chars`` are the largest shares of lines with a word, and of the characters of
    such lines, that repeat an earlier line.
    """

    min_words: int = 50
    base_run: int = 3
    base_percent: int = 50
    covered: tuple[tuple[int, int], ...] = ((5, 30), (7, 26), (10, 20))
    dup_lines: int = 50
    dup_line_chars: int = 20


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key stands elsewhere too, and those of them that are not the first."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    shared, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(twice):
        # A small table of low bits leaves few keys to look up.
        seen = np.zeros(1 << 18, bool)
        low = np.uint64(len(seen) - 1)
        seen[twice & low] = True
        places = np.flatnonzero(seen[keys & low])
        near = keys[places]
        at = np.minimum(np.searchsorted(twice, near), len(twice) - 1)
        places, near = places[twice[at] == near], near[twice[at] == near]
        order = np.argsort(near, kind="stable")
        shared[places] = True
        later[places[order[1:][near[order][1:] == near[order][:-1]]]] = True
    return shared, later


def _covered(places: np.ndarray, run: int, size: int) -> np.ndarray:
    """Words that lie in one of the runs that start at ``places``."""
    edges = np.zeros(size + 1, np.int32)
    edges[:-1] += places
    edges[run:] -= places[: size + 1 - run]
    return np.cumsum(edges[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray, rules: QualityRules) -> dict[str, np.ndarray]:
    """All measures of the texts, one array per name."""
    n_texts = len(offsets) - 1
    total = lambda at, weights=None: np.bincount(at, weights, n_texts).astype(np.int64)
    leads = (data & 0xC0) != 0x80
    spaces = hashing._SPACE[data]
    out = {
        "word_chars": hashing.per_text(leads & ~spaces, offsets),
        "n_symbols": hashing.per_text(_SYMBOL[data], offsets),
    }
    words = hashing.words(data, offsets, lower=False)
    out["n_words"] = total(words.texts)

    # Lines: a text ends its last one; an empty text has one empty line.
    breaks = np.flatnonzero(data == 10)
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    line_text = np.repeat(np.arange(n_texts), 1 + hashing.per_text(data == 10, offsets))
    starts = np.empty_like(ends)
    starts[0:1] = 0
    starts[1:] = ends[:-1] + 1
    first = np.r_[True, line_text[1:] != line_text[:-1]] if len(ends) else np.zeros(0, bool)
    starts[first] = offsets[:-1]
    lengths = ends - starts
    chars_before = np.concatenate([[0], np.cumsum(leads, dtype=np.int32)])
    line_chars = chars_before[ends] - chars_before[starts]
    words_before = np.searchsorted(words.starts, starts)
    filled = np.searchsorted(words.starts, ends) > words_before
    keys = hashing.segment_hashes(data[data != 10], lengths)[filled]
    line_text, line_chars = line_text[filled], line_chars[filled]
    _, later = _repeats(keys ^ hashing.mix(line_text.astype(np.uint64) + _SALT))
    out["n_dup_lines"] = total(line_text[later])
    out["n_lines"] = total(line_text)
    out["line_chars"] = total(line_text, line_chars)
    out["dup_line_chars"] = total(line_text[later], line_chars[later])

    word_salt = hashing.mix(words.texts.astype(np.uint64) + _SALT)
    size = len(words.hashes)
    word_chars = chars_before[words.starts + words.lengths] - chars_before[words.starts]
    for run in (rules.base_run, *(n for n, _ in rules.covered)):
        shared = later = np.zeros(size, bool)
        if size >= run:
            whole = np.flatnonzero(words.texts[run - 1 :] == words.texts[: size - run + 1])
            keys = hashing.runs(words.hashes, run)[whole] ^ word_salt[whole]
            found = _repeats(keys)
            shared, later = np.zeros(size, bool), np.zeros(size, bool)
            shared[whole], later[whole] = found
        if run == rules.base_run:
            out["n_repeat_words"] = total(words.texts[_covered(shared, run, size)])
        else:
            inside = _covered(later, run, size)
            out[f"covered_{run}"] = total(words.texts[inside], word_chars[inside])
    return out


def verdict(m: dict[str, np.ndarray], rules: QualityRules) -> tuple[np.ndarray, np.ndarray]:
    """Base failure, and whether the text is kept."""
    words = m["n_words"]
    failed = (words < rules.min_words) | (100 * m["n_repeat_words"] > rules.base_percent * words)
    kept = ~failed
    for run, most in rules.covered:
        kept &= 100 * m[f"covered_{run}"] <= most * m["word_chars"]
    kept &= 100 * m["n_dup_lines"] <= rules.dup_lines * m["n_lines"]
    kept &= 100 * m["dup_line_chars"] <= rules.dup_line_chars * m["line_chars"]
    return failed, kept


def repetition_profile(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: QualityRules | None = None
) -> DataFrame:
    """Per row: the id, the measures, ``covered_<n>`` per run length, line measures, verdict.

    Only the two columns are read, so other columns and their names do not matter.  Repeated
    rows give repeated results; a null id stays null; an empty table gives an empty one.
    """
    rules = rules or QualityRules()
    extra = ["n_lines", "line_chars", "dup_line_chars", *(f"covered_{n}" for n, _ in rules.covered)]
    kind = dict(df.select(id_col).dtypes)[id_col]
    names = [*(x.split()[0] for x in MEASURES.split(", ")), *extra]
    schema = f"`{id_col}` {kind}, {MEASURES}, {', '.join(f'{x} long' for x in extra)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in hashing.text_slices(batches, 1):
            measures = measure(data, offsets, rules)
            failed, kept = verdict(measures, rules)
            columns = [pa.array(measures[x], pa.int64()) for x in names]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *columns, pa.array(failed), pa.array(kept)],
                [id_col, *names, "base_failed", "kept"],
            )

    narrow = df.select(id_col, F.col(text_col).cast("string").alias("_text"))
    return narrow.mapInArrow(run, f"{schema}, base_failed boolean, kept boolean")


def keep_quality(
    df: DataFrame, text_col: str = "text", rules: QualityRules | None = None
) -> DataFrame:
    """The rows that pass, with all their columns unchanged."""
    rules = rules or QualityRules()
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in hashing.text_slices(batches, at):
            _, kept = verdict(measure(data, offsets, rules), rules)
            yield part.filter(pa.array(kept))

    return df.mapInArrow(run, df.schema)
