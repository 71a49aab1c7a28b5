"""Main text of HTML pages by a recurrent labeller of text blocks.

A page becomes the sequence of its leaf blocks.  A block is described by hashed vectors of its
tag path and of its words and by a few numbers; a bidirectional LSTM in numpy reads the whole
sequence and says for every block whether it belongs to the article.  The labeller is trained
on the driver on a bounded sample of pages, whose labels come from their own semantic tags,
and on built pages with menus, notices, adverts, forms and comments.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstride.llm.hashing import text_slices, words

# Element names by their role in HTML: fixed values.
SKIPPED = frozenset(
    "canvas head iframe noscript script select style svg template textarea title".split()
)
RAW = frozenset("iframe noscript script style template textarea title".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var wbr "
    "math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow "
    "ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
IN_HEAD = frozenset(
    "base basefont bgsound link meta noframes noscript script style template title".split()
)
CLOSED_BY_LIKE = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTENT_TAGS = frozenset(["article", "main"])
OTHER_TAGS = frozenset(["aside", "dialog", "footer", "form", "header", "menu", "nav"])
OTHER_NAMES = frozenset(
    "ad ads advert banner breadcrumb comment comments cookie footer header menu nav newsletter "
    "notice promo related share sidebar sponsored".split()
)

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")

_PATH, _LEAF, _WORD, _NUMBERS = 96, 32, 48, 6
WIDTH = _PATH + _LEAF + _WORD + _NUMBERS


@dataclass
class Block:
    """Text of a leaf block, its path (names of its ancestors, outermost first), linked characters."""

    text: str
    path: tuple[tuple[str, ...], ...]
    linked: int


def leaf_blocks(html: str) -> list[Block]:
    """Blocks with text in page order; markup, scripts, styles and the like are left out."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = skipped = at = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split()) if parts else ""
        if text:
            blocks.append(Block(text, tuple(n for t, n in stack if t not in INLINE), linked))
        parts.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal links, skipped
        if any(t not in INLINE for t, _ in stack[depth:]):
            close()
        for tag, _ in stack[depth:]:
            links -= tag == "a"
            skipped -= tag in SKIPPED
        del stack[depth:]

    while at < len(html):
        to = html.find("<", at)
        to = len(html) if to < 0 else to
        if to > at and stack and stack[-1][0] == "head" and not html[at:to].isspace():
            pop_to(len(stack) - 1)
        if to > at and not skipped:
            text = unescape(html[at:to])
            parts.append(text)
            linked += len(text) if links else 0
        if to == len(html):
            break
        at = to
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            at = len(html) if end < 0 else end + 3
            continue
        found = _TAG.match(html, at) or _LOOSE.match(html, at)
        if not found:
            if at + 1 < len(html) and (html[at + 1].isalpha() or html[at + 1] in "/!?"):
                end = html.find(">", at)
                at = len(html) if end < 0 else end + 1
            else:
                if not skipped:
                    parts.append("<")
                at += 1
            continue
        at = found.end()
        closing, tag, rest = found.group(1), found.group(2).lower(), found.group(3)
        if closing:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == tag), -1)
            if depth >= 0:
                pop_to(depth)
            elif tag not in INLINE:
                close()
            continue
        if tag == "head" and (blocks or any(t != "html" for t, _ in stack) or "".join(parts).strip()):
            continue
        if stack and stack[-1][0] == "head" and tag not in IN_HEAD:
            pop_to(len(stack) - 1)
        if tag in VOID:
            if tag not in INLINE and not skipped:
                close()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            if not skipped and tag not in INLINE:
                close()
            continue
        if tag not in INLINE:
            close()
            likes = CLOSED_BY_LIKE.get(tag, ())
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in likes:
                    pop_to(depth)
                    break
                if stack[depth][0] not in INLINE and stack[depth][0] != "p":
                    break
        names = (tag,)
        if rest and "=" in rest:
            for value in _NAMES.findall(rest):
                names += tuple(_WORDS.findall(value.lower()))
        stack.append((tag, names))
        links += tag == "a"
        skipped += tag in SKIPPED and not rest.endswith("/")
        if tag in SKIPPED and rest.endswith("/"):
            stack.pop()
    close()
    return blocks


def _bucket(word: str, width: int) -> int:
    return zlib.crc32(word.encode()) % width


def describe(blocks: Sequence[Block], paths: dict, mute: frozenset[str] = frozenset()) -> np.ndarray:
    """One row of features per block of a page; names in ``mute`` are left out of the paths."""
    x = np.zeros((len(blocks), WIDTH), np.float32)
    if not len(blocks):
        return x
    for row, block in enumerate(blocks):
        vector = None if mute else paths.get(block.path)
        if vector is None:
            vector = np.zeros(_PATH + _LEAF, np.float32)
            for names in block.path:
                for name in names:
                    if name not in mute:
                        vector[_bucket(name, _PATH)] = 1
            for name in block.path[-1] if block.path else ():
                if name not in mute:
                    vector[_PATH + _bucket(name, _LEAF)] = 1
            if not mute and len(paths) < 20_000:
                paths[block.path] = vector
        x[row, : _PATH + _LEAF] = vector
    data = [b.text.encode() for b in blocks]
    offsets = np.cumsum([0, *map(len, data)])
    found = words(np.frombuffer(b"".join(data), np.uint8), offsets, lower=True)
    cell = found.texts * _WORD + (found.hashes % np.uint64(_WORD)).astype(np.int64)
    counts = np.bincount(cell, minlength=len(blocks) * _WORD).reshape(len(blocks), _WORD)
    total = counts.sum(axis=1)
    x[:, _PATH + _LEAF : -_NUMBERS] = counts / np.maximum(np.sqrt(total), 1)[:, None]
    sizes = np.array([len(b.text) for b in blocks], np.float32)
    x[:, -6] = np.log1p(sizes) / 6
    x[:, -5] = np.array([b.linked for b in blocks]) / np.maximum(sizes, 1)
    x[:, -4] = np.arange(len(blocks)) / len(blocks)
    x[:, -3] = np.array([b.text.endswith((".", "!", "?")) for b in blocks])
    x[:, -2] = np.log1p(total) / 5
    x[:, -1] = np.array([sum(map(b.text.count, ",.;")) for b in blocks]) / np.maximum(sizes, 1) * 10
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights of the two directions (input, recurrent, bias) and of the output."""

    forward: list[np.ndarray]
    backward: list[np.ndarray]
    out: list[np.ndarray]

    @staticmethod
    def fresh(hidden: int, seed: int) -> Labeller:
        draw = np.random.default_rng(seed)

        def direction() -> list[np.ndarray]:
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1
            return [
                draw.normal(0, 0.1, (WIDTH, 4 * hidden)).astype(np.float32),
                draw.normal(0, 0.2, (hidden, 4 * hidden)).astype(np.float32),
                bias,
            ]

        out = [draw.normal(0, 0.2, 2 * hidden).astype(np.float32), np.zeros(1, np.float32)]
        return Labeller(direction(), direction(), out)

    @property
    def weights(self) -> list[np.ndarray]:
        return [*self.forward, *self.backward, *self.out]


def _run(weights: list[np.ndarray], gates: np.ndarray, keep: bool):
    """States of one direction from the projected inputs ``(time, pages, 4 hidden)``."""
    _, recurrent, _ = weights
    hidden = recurrent.shape[0]
    h = np.zeros((gates.shape[1], hidden), np.float32)
    c = np.zeros_like(h)
    states, saved = np.empty((len(gates), *h.shape), np.float32), []
    for t in range(len(gates)):
        z = gates[t] + h @ recurrent
        ifo = _sigmoid(z[:, : 3 * hidden])
        g = np.tanh(z[:, 3 * hidden :])
        i, f, o = ifo[:, :hidden], ifo[:, hidden : 2 * hidden], ifo[:, 2 * hidden :]
        before, before_h = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        states[t] = h
        if keep:
            saved.append((i, f, o, g, before, before_h, squashed))
    return states, saved


def _run_back(weights, saved, grad: np.ndarray):
    """Gradients of a direction's gates and recurrent weights from those of its states."""
    _, recurrent, _ = weights
    hidden = recurrent.shape[0]
    dz = np.empty((*grad.shape[:2], 4 * hidden), np.float32)
    d_recurrent = np.zeros_like(recurrent)
    dh = np.zeros(grad.shape[1:], np.float32)
    dc = np.zeros_like(dh)
    for t in range(len(grad) - 1, -1, -1):
        i, f, o, g, before, before_h, squashed = saved[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squashed**2)
        dz[t] = np.concatenate(
            [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)],
            axis=1,
        )
        d_recurrent += before_h.T @ dz[t]
        dh = dz[t] @ recurrent.T
        dc = dc * f
    return dz, d_recurrent


def _reversal(lengths: np.ndarray, time: int) -> np.ndarray:
    """Place each step comes from when every page is read from its last block."""
    steps = np.arange(time)[:, None]
    return np.where(steps < lengths, lengths - 1 - steps, steps)


def _forward_pass(model: Labeller, pages: Sequence[np.ndarray], keep: bool = False):
    lengths = np.array([len(p) for p in pages])
    time = int(lengths.max())
    turn = _reversal(lengths, time)
    columns = np.arange(len(pages))
    flat = np.concatenate(pages)
    place = np.concatenate([np.arange(n) * len(pages) + b for b, n in enumerate(lengths)])

    def gates(weights: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((time * len(pages), weights[0].shape[1]), np.float32)
        out[place] = flat @ weights[0] + weights[2]
        return out.reshape(time, len(pages), -1)

    first, saved_first = _run(model.forward, gates(model.forward), keep)
    second, saved_second = _run(model.backward, gates(model.backward)[turn, columns], keep)
    second = second[turn, columns]
    both = np.concatenate([first, second], axis=2)
    scores = both @ model.out[0] + model.out[1]
    return scores, (flat, place, turn, columns, both, saved_first, saved_second)


def predict(model: Labeller, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Per page whether each block belongs to the article."""
    order = np.argsort([len(p) for p in pages], kind="stable")
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    group: list[int] = []

    def flush() -> None:
        if group:
            scores, _ = _forward_pass(model, [pages[n] for n in group])
            for b, n in enumerate(group):
                out[n] = scores[: len(pages[n]), b] > 0
            group.clear()

    for n in order.tolist():
        if not len(pages[n]):
            continue
        # Bounded padding: pages of like length, and few of the long ones, at a time.
        if group and (len(group) >= 256 or len(pages[n]) * (len(group) + 1) > 20_000
                      or len(pages[n]) > 2 * len(pages[group[0]]) + 8):
            flush()
        group.append(n)
    flush()
    return out


def train(
    pages: Sequence[np.ndarray], labels: Sequence[np.ndarray], hidden: int = 16, epochs: int = 12,
    batch: int = 24, rate: float = 0.01, seed: int = 42,
) -> Labeller:
    """Adam on the mean cross-entropy of the blocks, with pages of like length in a batch."""
    model = Labeller.fresh(hidden, seed)
    weights = model.weights
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    draw = np.random.default_rng(seed)
    order = np.argsort([len(p) for p in pages], kind="stable")
    batches = [order[i : i + batch] for i in range(0, len(order), batch)]
    step = 0
    for _ in range(epochs):
        for chosen in (batches[i] for i in draw.permutation(len(batches))):
            x, y = [pages[n] for n in chosen], [labels[n] for n in chosen]
            scores, (flat, place, turn, columns, both, sf, sb) = _forward_pass(model, x, keep=True)
            target = np.zeros(scores.size, np.float32)
            mask = np.zeros(scores.size, np.float32)
            target[place], mask[place] = np.concatenate(y), 1
            ds = ((_sigmoid(scores) - target.reshape(scores.shape)) * mask.reshape(scores.shape) / mask.sum()).astype(np.float32)
            d_out = [np.tensordot(ds, both, ([0, 1], [0, 1])), np.array([ds.sum()], np.float32)]
            d_both = ds[:, :, None] * model.out[0]
            dz, d_rec = _run_back(model.forward, sf, d_both[:, :, :hidden])
            grads = [flat.T @ dz.reshape(-1, 4 * hidden)[place], d_rec, dz.sum((0, 1))]
            dz, d_rec = _run_back(model.backward, sb, d_both[:, :, hidden:][turn, columns])
            dz = dz[turn, columns]
            grads += [flat.T @ dz.reshape(-1, 4 * hidden)[place], d_rec, dz.sum((0, 1)), *d_out]
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads))
            step += 1
            for w, g, a, b in zip(weights, grads, first, second, strict=True):
                g = g * min(1, 5 / max(norm, 1e-9))
                a += 0.1 * (g - a)
                b += 0.001 * (g**2 - b)
                w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return model


def tag_labels(blocks: Sequence[Block]) -> np.ndarray | None:
    """Labels by the page's own semantic tags; None for a page without an article."""
    out = np.zeros(len(blocks), np.float32)
    for n, block in enumerate(blocks):
        inside = False
        for names in block.path:
            if names[0] in CONTENT_TAGS:
                inside = True
            if names[0] in OTHER_TAGS or OTHER_NAMES & set(names[1:]):
                inside = False
        out[n] = inside
    return out if out.any() else None


def build_pages(texts: Sequence[str], n: int, seed: int) -> list[tuple[str, np.ndarray]]:
    """Pages put together from sentences, with the label of each block in order."""
    draw = np.random.default_rng(seed)
    texts = list(texts) or ["A short line of plain words.", "Some more words, set in a second line."]
    wrap = [
        ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"),
        ('<div id="post-body">', "</div>"), ('<section class="entry story">', "</section>"),
        ('<main><article class="post">', "</article></main>"),
    ]
    around = [
        ('<nav><ul><li><a href="/a">', "</a></li></ul></nav>"), ('<div class="menu"><a href="/b">', "</a></div>"),
        ("<header><p>", "</p></header>"), ('<div class="header">', "</div>"), ("<footer>", "</footer>"),
        ('<div class="footer"><p>', "</p></div>"), ("<aside><p>", "</p></aside>"),
        ('<div class="sidebar"><p>', "</p></div>"), ('<div class="ad">', "</div>"),
        ('<div class="ads sponsored"><p>', "</p></div>"), ('<div class="promo"><a href="/c">', "</a></div>"),
        ('<div class="cookie notice"><p>', "</p></div>"), ('<div id="banner">', "</div>"),
        ("<form><p>", "</p></form>"), ('<form class="newsletter"><button>', "</button></form>"),
        ('<div class="comments"><div class="comment"><p>', "</p></div></div>"),
        ('<section id="comments"><p>', "</p></section>"), ('<ul class="related"><li><a href="/d">', "</a></li></ul>"),
        ('<div class="share"><a href="/e">', "</a></div>"), ('<div class="breadcrumb"><a href="/f">', "</a></div>"),
    ]

    def words_of(most: int) -> str:
        text = texts[draw.integers(len(texts))].split()
        return " ".join(text[: 1 + draw.integers(most)]) or "word"

    pages = []
    for _ in range(n):
        html, labels = ["<html><body>"], []

        def others(most: int) -> None:
            for _ in range(draw.integers(most + 1)):
                left, right = around[draw.integers(len(around))]  # noqa: B023
                for _ in range(1 + draw.integers(3)):
                    html.append(left + words_of(12) + right)  # noqa: B023
                    labels.append(0.0)  # noqa: B023

        others(4)
        left, right = wrap[draw.integers(len(wrap))]
        html.append(left)
        if draw.random() < 0.8:
            html.append(f"<h1>{words_of(10)}</h1>")
            labels.append(1.0)
        for _ in range(1 + draw.integers(8)):
            tag = ["p", "p", "p", "blockquote", "h2", "li", "pre"][draw.integers(7)]
            html.append(f"<{tag}>{words_of(60)}</{tag}>")
            labels.append(1.0)
            if draw.random() < 0.1:
                others(1)
        others(1)
        html.append(right)
        others(4)
        html.append("</body></html>")
        pages.append(("".join(html), np.array(labels, np.float32)))
    return pages


@dataclass(frozen=True)
class HtmlModel:
    """Pages of the table and built pages to learn from, longest page used, training sizes."""

    sampled: int = 240
    built: int = 360
    most_chars: int = 60_000
    hidden: int = 16
    epochs: int = 12
    seed: int = 42


def fit_labeller(df: DataFrame, html_col: str = "html", rules: HtmlModel | None = None) -> Labeller:
    """Labeller for the pages of ``df``; the same table gives the same weights."""
    rules = rules or HtmlModel()
    pages = df.select(F.col(html_col).cast("string").alias("html")).filter(
        F.length("html") <= rules.most_chars
    ).withColumn("place", F.xxhash64("html", F.lit(rules.seed)))
    # Only hashes are ordered; the pages themselves are fetched once the last one is known.
    places = pages.select("place").distinct().orderBy("place").limit(rules.sampled).collect()
    last = places[-1]["place"] if places else 0
    sample = sorted(
        pages.filter(F.col("place") <= last).dropDuplicates(["place"]).collect(),
        key=lambda row: row["place"],
    )
    draw = np.random.default_rng(rules.seed)
    rows, labels, texts = [], [], []
    for row in sample:
        blocks = leaf_blocks(row["html"])
        texts += [b.text for b in blocks]
        own = tag_labels(blocks)
        if own is not None:
            mute = CONTENT_TAGS if draw.random() < 0.15 else frozenset()
            rows.append(describe(blocks, {}, mute))
            labels.append(own)
    for page, own in build_pages(texts, rules.built, rules.seed):
        blocks = leaf_blocks(page)
        if len(blocks) == len(own):
            rows.append(describe(blocks, {}))
            labels.append(own)
    return train(rows, labels, rules.hidden, rules.epochs, seed=rules.seed)


def extract(
    df: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id", "url"),
    model: Labeller | None = None,
) -> DataFrame:
    """The columns of ``keep``, ``text`` (blocks of the article joined by a blank) and ``n_chars``.

    A null or empty page has an empty text; a cut-off page is read as far as it goes.  Repeated
    rows get equal texts; other columns are not read, so their names do not matter.
    """
    model = model or fit_labeller(df, html_col)
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", text string, n_chars long"
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: dict = {}
        for part, _, _ in text_slices(batches, at, most=1 << 20):
            pages = [leaf_blocks(h or "") for h in part.column(at).to_pylist()]
            chosen = predict(model, [describe(p, paths) for p in pages])
            texts = [
                " ".join(b.text for b, c in zip(blocks, inside.tolist(), strict=True) if c)
                for blocks, inside in zip(pages, chosen, strict=True)
            ]
            columns = [part.column(c) for c in range(at)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), sizes], [*keep, "text", "n_chars"])

    return df.select(*keep, F.col(html_col).cast("string").alias("_html")).mapInArrow(run, schema)
