"""Near-duplicate documents by bottom-k sketches of word shingles.

Documents with equal shingle sets form one class.  A class keeps the k smallest hashes of its
set, all from one hash function.  Inverted lists of these retained values bring classes
together: two sets as similar as asked share so many retained values that they meet in a list
of one of their rarest ones.  Lists with the same leading class are joined into one group; a
group is compared in blocks, where the overlap of sketches gives an estimate from the union
sketch, and pairs that pass are verified on the full sets.  A block hands on a spanning tree
of each cluster in it, never its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstride.llm.components import connected_components, join_classes, stored, with_least
from tabstride.llm.hashing import release_memory, runs, text_slices, words
from tabstride.session import broadcast_if_small


@dataclass(frozen=True)
class NearDup:
    """Words per shingle, similarity in percent, retained values, and sizes of a block.

    ``miss`` bounds the chance that a pair at the threshold meets in no list, and the chance
    that the estimate drops it.
    """

    shingle: int = 5
    percent: int = 80
    retained: int = 64
    block_rows: int = 512
    block_values: int = 1 << 20
    miss: float = 1e-12

    @property
    def shared(self) -> int:
        """Retained values that two similar large sets share, but for ``miss``."""
        return max(1, int(_least_shared(self)[self.retained]))


@lru_cache
def _least_shared(rules: NearDup) -> np.ndarray:
    """By number of values: how many of them a pair at the threshold shares at least.

    The exact binomial tail below it is under ``miss``.
    """
    t, out = rules.percent / 100, []
    for n in range(2 * rules.retained + 1):
        below, k = 0.0, 0
        while k <= n:
            below += math.comb(n, k) * t**k * (1 - t) ** (n - k)
            if below >= rules.miss:
                break
            k += 1
        out.append(k)
    return np.array(out, np.float64)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, size: int, lower: bool = True
) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    found = words(data, offsets, lower)
    edges = np.searchsorted(found.texts, np.arange(len(offsets)))
    hashes = runs(found.hashes, size)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(hashes[a : b - size + 1])
        elif b > a:
            yield runs(found.hashes[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def _class_id(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _set_table(df: DataFrame, id_col: str, text_col: str, rules: NearDup, whole: bool) -> DataFrame:
    """``id, n, class, values`` per row; ``values`` is the whole set or the retained part."""
    kind = dict(df.select(id_col).dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in text_slices(batches, 1):
            sets = list(shingle_sets(data, offsets, rules.shingle))
            parts = sets if whole else [s[: rules.retained] for s in sets]
            edges = np.concatenate([[0], np.cumsum([len(s) for s in parts])])
            flat = np.concatenate(parts).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_class_id(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat)),
                ],
                ["id", "n", "class", "values"],
            )

    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, n long, class binary, values array<long>")


def _listed(rules: NearDup, n: Column) -> Column:
    """How many of its rarest retained values a set of size ``n`` is listed under."""
    kept = F.least(n, F.lit(rules.retained))
    exact = F.ceil(n * rules.percent / 100)
    small = n < math.floor(rules.retained * rules.percent / 100)
    return kept - F.when(small, exact).otherwise(F.least(F.lit(rules.shared), exact)) + 1


def _groups(classes: DataFrame, rules: NearDup) -> DataFrame:
    """``lead, class, n``: classes that share a listed value, under the leading class there."""
    values = classes.filter("n > 0").select("class", F.explode("values").alias("v"))
    often = values.groupBy("v").agg(F.count("*").alias("f")).filter("f > 1")
    # A value found once is the rarest there is; it takes a place in the list but joins nobody.
    shared = values.join(often, "v").groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("f", "v"))).alias("s")
    )
    places = _listed(rules, F.col("n")) - (F.least("n", F.lit(rules.retained)) - F.size("s"))
    listed = shared.join(classes.select("class", "n", "copies"), "class").select(
        F.explode(F.slice("s", 1, F.greatest(places, F.lit(0)).cast("int"))["v"]).alias("v"),
        "class", "n", "copies",
    )
    listed = stored(listed, "lists")
    leads = listed.groupBy("v").agg(
        F.max(F.struct("copies", "class"))["class"].alias("lead"), F.count("*").alias("f")
    ).filter("f > 1").select("v", "lead")
    return stored(listed.join(leads, "v").select("lead", "class", "n").distinct(), "groups")


def _overlaps(owner: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sizes of all intersections; values that only one row holds are left out first."""
    distinct, place, count = np.unique(values, return_inverse=True, return_counts=True)
    common = count > 1
    column = (np.cumsum(common) - 1)[place]
    keep = common[place]
    owner, column = owner[keep], column[keep]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((rows, rows), np.float32)
    width = 4096
    for lo in range(0, int(common.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        held = np.zeros((rows, min(width, int(common.sum()) - lo)), np.float32)
        held[owner[a:b], column[a:b] - lo] = 1
        out += held @ held.T
    return out


def _estimates(sets: list[np.ndarray], rules: NearDup) -> tuple[np.ndarray, np.ndarray]:
    """Similarity estimated from the union of two sketches, and the values it rests on."""
    k, rows = rules.retained, len(sets)
    sketches = [s[:k] for s in sets]
    owner = np.repeat(np.arange(rows), [len(s) for s in sketches])
    shared = _overlaps(owner, np.concatenate(sketches), rows)
    # A whole set has no last retained value beyond which it is unknown.
    top = np.array([s[-1] if len(w) > k else np.iinfo(np.uint64).max for s, w in zip(sketches, sets, strict=True)], np.uint64)
    order = np.argsort(top)
    below = np.empty((rows, rows), np.float32)
    for i, s in enumerate(sketches):
        below[i, order] = np.searchsorted(s, top[order], "right")
    union = below + below.T - shared
    return shared / np.maximum(union, 1), union


def compare_block(
    keys: list[bytes], sets: list[np.ndarray], rules: NearDup
) -> list[tuple[bytes, bytes]]:
    """A link from each set to the first one of its cluster in the block."""
    sizes = np.array([len(s) for s in sets], np.float64)
    estimate, union = _estimates(sets, rules)
    t = rules.percent / 100
    whole = sizes <= rules.retained
    # The estimate rests on ``union`` values, each shared with the chance of the similarity.
    least = _least_shared(rules)[np.minimum(union, 2 * rules.retained).astype(np.int64)]
    least[np.ix_(whole, whole)] = (t * union - 1e-3)[np.ix_(whole, whole)]
    likely = estimate * union >= least - 0.5e-3
    np.fill_diagonal(likely, False)
    rows = np.flatnonzero(likely.any(axis=1))
    if not len(rows):
        return []
    owner = np.repeat(np.arange(len(rows)), sizes[rows].astype(np.int64))
    inter = _overlaps(owner, np.concatenate([sets[r] for r in rows]), len(rows)).astype(np.float64)
    both = sizes[rows][:, None] + sizes[rows][None, :] - inter
    linked = likely[np.ix_(rows, rows)] & (100 * inter >= rules.percent * both)
    links, free = [], np.ones(len(rows), bool)
    for first in range(len(rows)):
        if not free[first]:
            continue
        free[first] = False
        edge = np.array([first])
        while len(edge):
            edge = np.flatnonzero(linked[edge].any(axis=0) & free)
            free[edge] = False
            links += [(keys[rows[r]], keys[rows[first]]) for r in edge]
    return links


def _links(groups: DataFrame, sets: DataFrame, rules: NearDup) -> DataFrame:
    """Links ``a, b`` between classes that hold every cluster together."""
    sizes = groups.groupBy("lead").agg(F.count("*").alias("rows"), F.sum("n").alias("total"))
    blocks = F.greatest(
        F.ceil(F.col("rows") / rules.block_rows), F.ceil(F.col("total") / rules.block_values)
    )
    blocks = stored(sizes.select("lead", blocks.cast("int").alias("blocks")), "group_sizes")
    dealt = (
        groups.join(broadcast_if_small(blocks), "lead")
        .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "lead", "class",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
        .join(sets, "class")
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = table["class"].to_pylist()
        column = table["values"].combine_chunks()
        flat = column.values.to_numpy().view(np.uint64)
        edges = column.offsets.to_numpy()
        sets = [flat[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        links = compare_block(keys, sets, rules) if len(keys) > 1 else []
        release_memory()
        return pa.table({
            "a": pa.array([x for x, _ in links], pa.binary()),
            "b": pa.array([y for _, y in links], pa.binary()),
        })

    return dealt.groupBy("lead", "i", "j").applyInArrow(run, "a binary, b binary")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: NearDup | None = None
) -> DataFrame:
    """Per row ``id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id in the row's cluster and ``kept`` says that it is the
    row's own.  A text without words (or null) has an empty set and is its own cluster.  A
    null id is never a cluster's smallest unless all are null; it is kept only then.  Repeated
    rows share their id and their verdict.  Other columns are not read.
    """
    rules = rules or NearDup()
    rows = stored(_set_table(df, id_col, text_col, rules, whole=False), "sketches")
    classes = stored(
        rows.groupBy("class").agg(
            F.min("id").alias("least"), F.count("*").alias("copies"),
            F.first("n").alias("n"), F.first("values").alias("values"),
        ),
        "classes",
    )
    groups = _groups(classes, rules)
    wanted = stored(
        groups.select("class").distinct().join(classes.select("class", "least"), "class"), "wanted"
    )
    every = _set_table(df, id_col, text_col, rules, whole=True)
    near = broadcast_if_small(wanted.withColumnRenamed("class", "wanted"))
    found = (every["class"] == near["wanted"]) & every["id"].eqNullSafe(near["least"])
    sets = stored(
        every.join(near, found).select("class", "values").dropDuplicates(["class"]), "sets"
    )
    links = stored(_links(groups, sets, rules), "links")
    members = connected_components(links).select(F.col("node").alias("class"), "component")
    labelled = stored(members.join(classes.select("class", "least"), "class"), "members")
    parts = max(1, math.isqrt(labelled.count()))
    cluster = with_least(labelled, "component", "least", "smallest", parts).select("class", "smallest")
    answer = stored(
        classes.select("class", "least", "n", "copies").join(cluster, "class", "left")
        .select("class", F.coalesce("smallest", "least").alias("component_id"),
                (F.col("n") == 0).alias("empty"), "copies"),
        "verdicts",
    )
    own = F.when(F.col("empty"), F.col("id")).otherwise(F.col("component_id"))
    joined = join_classes(rows.select("id", "n", "class"), answer, "copies", rows.count())
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
        F.col("id").eqNullSafe(own).alias("kept"),
    )


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: NearDup | None = None
) -> DataFrame:
    """The rows whose id is the smallest of their cluster, with all columns.

    Rows without an id cannot be named and stay.
    """
    dropped = stored(
        near_duplicates(df, id_col, text_col, rules).filter(~F.col("kept"))
        .select(F.col(id_col).alias("_dropped")).filter("_dropped IS NOT NULL").distinct(),
        "dropped",
    )
    dropped = broadcast_if_small(dropped)
    return df.join(dropped, df[id_col] == dropped["_dropped"], "left_anti")
