"""Byte-pair encoding with word ends, many texts at a time.

A text is normalised (NFC, white space, lower case), cut into words by the tokenizer's
pattern, and every word is encoded on its own.  The cutting runs in numpy over code points;
each distinct word is then encoded once and its ids are copied to all its places.  Results
are those of the ``tokenizers`` library on the same file.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import types
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
from tokenizers import Regex
from tokenizers.normalizers import Lowercase
from tokenizers.pre_tokenizers import Split

from tabstride.llm.hashing import segment_hashes

# Distinct words that a worker keeps, and ids of a kept word at most.
CACHE_WORDS = 1 << 19
CACHE_IDS = 8
# Text bytes encoded at once: the more, the fewer words are met again.
SLICE_BYTES = 1 << 20

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
# Added to the class of a capital that this Python does not know; class of points not asked for.
_CAPITAL, _UNKNOWN = 8, 255
# Code points whose classes are asked for together.
_PAGE = 1 << 12
_APOSTROPHE = 39
# Endings that stay together with an apostrophe in front: fixed values.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
# Bytes up to which words are merged side by side, in groups of like length.
_GROUPS = (4, 8, 16, 32)
_NONE = np.iinfo(np.int64).max
_LOW = (1 << 32) - 1

# UTF-8 bytes of words, one after another, and their lengths -> all ids, and their counts.
EncodeWords = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, for tables costly to build."""
    name = "_tabstride_worker_state"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def byte_letters() -> list[str]:
    """A visible character for each byte: itself if it is one, else the next from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class CharacterClasses:
    """Class of each code point, as the library's own patterns see it, page by page on demand.

    ``capitals`` maps letters that this Python does not know yet to the library's lower case.
    """

    def __init__(self) -> None:
        self.table = np.full(sys.maxunicode + 1, _UNKNOWN, np.uint8)
        self.capitals: dict[int, str] = {}

    def of(self, points: np.ndarray) -> np.ndarray:
        found = self.table[points]
        unknown = found == _UNKNOWN
        if unknown.any():
            for page in np.unique(points[unknown] // _PAGE).tolist():
                self._fill(page * _PAGE)
            found = self.table[points]
        return found

    def _fill(self, first: int) -> None:
        points = np.arange(first, first + _PAGE, dtype="<u4")
        points[(points >= 0xD800) & (points < 0xE000)] = 0  # surrogates stand in no text
        text = points.tobytes().decode("utf-32-le")
        classes = np.full(_PAGE, _OTHER, np.uint8)
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for _, (start, end) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(text):
                classes[start:end] = kind
        library = Lowercase()
        strange = [c for c in text if unicodedata.category(c) == "Cn"]
        if library.normalize_str("".join(strange)) != "".join(strange):
            for c in strange:
                lower = library.normalize_str(c)
                if lower != c:
                    self.capitals[ord(c)] = lower
                    classes[ord(c) - first] |= _CAPITAL
        self.table[first : first + _PAGE] = classes


class BpeFile:
    """Vocabulary, merge ranks and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for string, number in [*vocab.items(), *self.special.items()]:
            self.strings[number] = string
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + self.end] for x in letters]
        # left * 2**32 + right -> rank * 2**32 + merged symbol
        self.merges = {
            vocab[a] << 32 | vocab[b]: rank << 32 | vocab[a + b]
            for rank, (a, b) in enumerate(spec["model"]["merges"])
        }
        self.splitter = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def encode_word(self, data: bytes) -> list[int]:
        """Ids of one word from its UTF-8 bytes.

        The symbols form a doubly linked list; a queue holds every pair that can merge by
        rank and place.  An entry whose pair has changed since is stale and skipped.
        """
        ids = [self.inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        size = len(ids)
        if size == 1:
            return ids
        merges, low = self.merges, _LOW
        before = list(range(-1, size - 1))
        after = [*range(1, size), -1]
        queue = []
        for i in range(size - 1):
            found = merges.get(ids[i] << 32 | ids[i + 1])
            if found is not None:
                queue.append((found >> 32, i, found & low))
        heapq.heapify(queue)
        while queue:
            rank, i, merged = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0 or merges.get(ids[i] << 32 | ids[j]) != rank << 32 | merged:
                continue
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                found = merges.get(merged << 32 | ids[k])
                if found is not None:
                    heapq.heappush(queue, (found >> 32, i, found & low))
            k = before[i]
            if k >= 0:
                found = merges.get(ids[k] << 32 | merged)
                if found is not None:
                    heapq.heappush(queue, (found >> 32, k, found & low))
        return [x for x in ids if x >= 0]

    def encode_words(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _flat([self.encode_word(w) for w in _cut(data, lengths)])

    def decode(self, ids: Sequence[int]) -> str:
        """Vocabulary strings one after another, with a blank between them."""
        return " ".join([self.strings[i] for i in ids])


def _cut(data: np.ndarray, lengths: np.ndarray) -> Iterator[bytes]:
    whole, at = data.tobytes(), 0
    for n in lengths.tolist():
        yield whole[at : at + n]
        at += n


def _flat(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(counts.sum())), counts


class SideBySide:
    """Merges many words at once, in numpy.

    A step merges in every word the leftmost of its pairs of least rank, as the queue of
    ``BpeFile.encode_word`` would.  Words of more than 32 bytes go through that queue.
    """

    def __init__(self, file: BpeFile):
        self.file = file
        self.inner, self.last = np.array(file.inner, np.int64), np.array(file.last, np.int64)
        # A table of pairs; those that fall on a taken place go to the next, smaller one.
        keys = np.fromiter(file.merges, np.int64, len(file.merges))
        values = np.fromiter(file.merges.values(), np.int64, len(keys))
        self.tables: list[tuple[int, np.ndarray, np.ndarray]] = []
        bits = max(4, len(keys).bit_length() + 2)
        while len(keys):
            places = self._place(keys, bits)
            first = np.unique(places, return_index=True)[1]
            held, ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int64)
            held[places[first]], ranks[places[first]] = keys[first], values[first]
            self.tables.append((bits, held, ranks))
            keys, values = np.delete(keys, first), np.delete(values, first)
            bits = max(4, bits - 2)

    @staticmethod
    def _place(keys: np.ndarray, bits: int) -> np.ndarray:
        # An odd multiplier per table, so that pairs that clash in one part in the next.
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * bits)
        return (spread >> np.uint64(64 - bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``rank << 32 | merged`` of each pair, or ``_NONE``; a negative symbol has no pair."""
        keys = np.where((left < 0) | (right < 0), -2, left << 32 | right)
        found = np.full(len(keys), _NONE, np.int64)
        for bits, held, ranks in self.tables:
            places = self._place(keys, bits)
            np.copyto(found, ranks[places], where=held[places] == keys)
        return found

    def encode_words(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum(lengths) - lengths
        counts = np.zeros(len(lengths), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        least = 0
        for most in _GROUPS:
            rows = np.flatnonzero((lengths > least) & (lengths <= most))
            least = most
            if len(rows):
                done += self._merge(data, starts[rows], lengths[rows], rows, counts)
        for row in np.flatnonzero(lengths > least).tolist():
            at = int(starts[row])
            ids = np.array(self.file.encode_word(data[at : at + int(lengths[row])].tobytes()), np.int64)
            counts[row] = len(ids)
            done.append((np.array([row]), ids[:, None]))
        begins = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        for rows, symbols in done:
            size, begin = counts[rows], begins[rows]
            for i in range(len(symbols)):
                there = size > i
                flat[begin[there] + i] = symbols[i, there]
        return flat, counts

    def _merge(
        self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray, counts: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Symbols of words, place by place; ``counts`` gets their numbers."""
        width = int(sizes.max())
        places = np.arange(width)[:, None]
        raw = data[np.minimum(starts + places, len(data) - 1)]
        symbols = np.where(places < sizes - 1, self.inner[raw], self.last[raw])
        symbols[places >= sizes] = -1
        ranks = np.stack(
            [self._ranks(symbols[i], symbols[i + 1]) for i in range(width - 1)]
            or [np.full(len(rows), _NONE, np.int64)]
        )
        while True:
            best = ranks.min(axis=0)
            going = best != _NONE
            if not going.all():
                ended = ~going
                counts[rows[ended]] = (symbols[:, ended] >= 0).sum(axis=0)
                yield rows[ended], symbols[:, ended]
                rows, symbols, ranks, best = rows[going], symbols[:, going], ranks[:, going], best[going]
            if not len(rows):
                return
            at, column = np.argmin(ranks, axis=0), np.arange(len(rows))
            # Everything behind the merged pair moves up by one place.
            for i in range(1, len(symbols)):
                np.copyto(symbols[i], symbols[i + 1] if i + 1 < len(symbols) else -1, where=at < i)
            for i in range(1, len(ranks)):
                np.copyto(ranks[i], ranks[i + 1] if i + 1 < len(ranks) else _NONE, where=at < i)
            symbols[at, column] = best & _LOW
            ranks[at, column] = self._ranks(
                symbols[at, column], symbols[np.minimum(at + 1, len(symbols) - 1), column]
            )
            follows = np.flatnonzero(at)
            before = at[follows] - 1
            ranks[before, follows] = self._ranks(
                symbols[before, follows], symbols[at[follows], follows]
            )


class WordCache:
    """Ids of words by hash, one word at a place: a word that comes later takes the place."""

    def __init__(self) -> None:
        self.places = 1 << (max(CACHE_WORDS, 1) - 1).bit_length()
        self.keys = np.zeros(self.places, np.uint64)
        self.counts = np.zeros(self.places, np.int64)
        self.ids = np.zeros((self.places, CACHE_IDS), np.int32)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        places = (keys & np.uint64(self.places - 1)).astype(np.int64)
        return places, (self.keys[places] == keys) & (self.counts[places] > 0)

    def add(self, keys: np.ndarray, places: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        # Of words for one place only one may go in, or its parts would mix.
        chosen = np.unique(places, return_index=True)[1]
        chosen = chosen[counts[chosen] <= CACHE_IDS]
        starts, to = (np.cumsum(counts) - counts)[chosen], places[chosen]
        self.keys[to], self.counts[to] = keys[chosen], counts[chosen]
        for i in range(CACHE_IDS):
            there = counts[chosen] > i
            self.ids[to[there], i] = ids[starts[there] + i]


class TextEncoder:
    """Encodes batches of texts; ``encode_words`` gives the ids of words not met before."""

    def __init__(self, encode_words: EncodeWords, special: dict[str, int]):
        self.encode_words = encode_words
        self.special = special
        self.splitter = re.compile("|".join(map(re.escape, special))) if special else None
        self.classes = CharacterClasses()
        self.cache = WordCache()

    @staticmethod
    def _normal(text: str) -> str:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Lower case goes letter by letter, so a sigma at the end of a word is an ordinary one.
        return text.replace("Σ", "σ").lower()

    @staticmethod
    def _words(points: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and length of each word."""
        inside = classes != _SPACE
        begins = np.empty(len(points), bool)
        begins[0] = True
        begins[1:] = classes[1:] != classes[:-1]
        begins |= classes == _NUMBER
        begins &= inside
        for at in np.flatnonzero(begins & (points == _APOSTROPHE)).tolist():
            tail = "".join(map(chr, points[at + 1 : at + 3].tolist()))
            ending = next((e for e in _ENDINGS if tail.startswith(e)), None)
            if ending:
                begins[at + 1] = False
                to = at + 1 + len(ending)
                begins[to : to + 1] = inside[to : to + 1]
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside)))
        return starts, sizes

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text as int32."""
        units, owners, fixed = [], [], {}
        for i, text in enumerate(texts):
            if self.splitter and "<" in text and (marks := self.splitter.findall(text)):
                for part, mark in zip(self.splitter.split(text), [*marks, None], strict=True):
                    units.append(self._normal(part))
                    owners.append(i)
                    if mark:
                        fixed[len(units) - 1] = self.special[mark]
            else:
                units.append(self._normal(text))
                owners.append(i)
        pieces = self._encode_units(units)
        if len(units) == len(texts):
            return pieces
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for n, (owner, ids) in enumerate(zip(owners, pieces, strict=True)):
            parts[owner].append(ids)
            if n in fixed:
                parts[owner].append(np.array([fixed[n]], np.int32))
        return [np.concatenate(p) for p in parts]

    def _points(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the texts, a line break after each, and their classes."""
        points = np.frombuffer(("\n".join(units) + "\n").encode("utf-32-le"), np.uint32)
        return points, self.classes.of(points)

    def _encode_units(self, units: list[str]) -> list[np.ndarray]:
        points, classes = self._points(units)
        if (classes >= _CAPITAL).any():
            units = [u.translate(self.classes.capitals) for u in units]
            points, classes = self._points(units)
        starts, sizes = self._words(points, classes)
        limits = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1)
        if not len(starts):
            return [np.zeros(0, np.int32) for _ in units]
        hashes = segment_hashes(points[classes != _SPACE], sizes)
        keys, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        begins, counts, table = self._ids(keys, points, starts[first], sizes[first])
        each = counts[place]
        ends = np.cumsum(each)
        ids = table[np.repeat(begins[place] - (ends - each), each) + np.arange(ends[-1])]
        words_before = np.searchsorted(starts, limits)
        edges = np.concatenate([[0], ends])[words_before]
        return np.split(ids, edges[:-1])

    def _ids(
        self, keys: np.ndarray, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and number of the ids of distinct words in a table, and the table."""
        places, known = self.cache.look_up(keys)
        old, new = np.flatnonzero(known), np.flatnonzero(~known)
        begins, counts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        begins[old], counts[old] = np.arange(len(old)) * CACHE_IDS, self.cache.counts[places[old]]
        table = self.cache.ids[places[old]].ravel()
        if len(new):
            ends = np.cumsum(sizes[new])
            at = np.repeat(starts[new] - (ends - sizes[new]), sizes[new]) + np.arange(ends[-1])
            chosen = points[at]
            width = 1 + (chosen > 0x7F) + (chosen > 0x7FF) + (chosen > 0xFFFF)
            data = np.frombuffer(chosen.tobytes().decode("utf-32-le").encode(), np.uint8)
            lengths = np.add.reduceat(width.astype(np.int64), ends - sizes[new])
            ids, counts[new] = self.encode_words(data, lengths)
            begins[new] = len(table) + np.cumsum(counts[new]) - counts[new]
            self.cache.add(keys[new], places[new], ids, counts[new])
            table = np.concatenate([table, ids])
        return begins, counts, table


def own_encoder(path: str) -> tuple[TextEncoder, BpeFile]:
    """Encoder on the merge queue of this module, kept for the life of the worker."""
    state = worker_state()
    key = f"own {path}"
    if key not in state:
        file = BpeFile(path)
        state[key] = TextEncoder(file.encode_words, file.special), file
    return state[key]


def fast_encoder(path: str) -> TextEncoder:
    """Encoder that merges the words not met before side by side."""
    state = worker_state()
    key = f"fast {path}"
    if key not in state:
        file = BpeFile(path)
        state[key] = TextEncoder(SideBySide(file).encode_words, file.special)
    return state[key]


def library_encoder(path: str) -> TextEncoder:
    """Encoder that asks the ``tokenizers`` library for words not met before."""
    state = worker_state()
    key = f"library {path}"
    if key not in state:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        special = {t.content: n for n, t in library.get_added_tokens_decoder().items()}

        def encode_words(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            # In this tokenizer a word is encoded on its own as it is inside a text.
            words = [w.decode() for w in _cut(data, lengths)]
            return _flat([x.ids for x in library.encode_batch_fast(words, add_special_tokens=False)])

        state[key] = TextEncoder(encode_words, special)
    return state[key]
