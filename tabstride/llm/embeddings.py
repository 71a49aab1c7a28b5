"""Near-duplicate vectors: spherical k-means cells and blocked cosine products.

Equal vectors of a label form one class.  A bounded sample gives the centroids, of which a label
uses as many as its own size asks for.  A class owns the cell of its nearest centroid and visits
each earlier cell that a vector linked with it could own, so a pair is compared only in the
earlier of its two cells.  A cell's owners are compared in blocks with each other and with its
visitors, visitors never with visitors.  A block hands on, per class, how many vectors it is
linked with and one link that holds its cluster together, never the pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstride.llm.components import connected_components, join_classes, stored, with_least
from tabstride.session import broadcast_if_small


@dataclass(frozen=True)
class Cells:
    """Least cosine; owners per cell aimed at, cells and sample at most, owners of a block.

    A block of visitors is ``visitor_blocks`` times as large.

    With ``slack`` 1 every link is found: two unit vectors with cosine c differ by at most
    ``r = sqrt(2 - 2c)`` and their scores against two centroids by at most r times the
    centroids' distance.  A smaller slack visits fewer cells and loses links, the more the
    fewer directions the vectors use.
    """

    cosine: float = 0.98
    cell_vectors: int = 512
    most_cells: int = 2048
    most_sampled: int = 20_000
    rounds: int = 8
    block_rows: int = 1024
    visitor_blocks: int = 4
    slack: float = 1.0
    seed: int = 42


def spherical_kmeans(sample: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Unit centroids of unit vectors."""
    draw = np.random.default_rng(seed)
    centroids = sample[draw.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.argmax(sample @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centroids)
    return centroids


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit rows in double precision from lists of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    # Scaled first, so that squares neither vanish nor overflow.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _usable() -> Column:
    """Whether a row has a label and a finite vector that is not null, empty or zero."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & fine & some, F.lit(False))


def _cells(classes: DataFrame, centroids: np.ndarray, rules: Cells) -> DataFrame:
    """``class, label, dim, copies, v, cell, owner``: the own cell and the visited ones."""
    radius = math.sqrt(2 - 2 * rules.cosine) * rules.slack
    apart = np.sqrt(np.maximum(0, 2 - 2 * centroids @ centroids.T))
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            own, cells = np.zeros(batch.num_rows, np.int64), [[0]] * batch.num_rows
            rows = np.flatnonzero(batch.column("dim").to_numpy() == dim)
            if len(rows):
                scores = _matrix(lists.take(pa.array(rows))) @ centroids.T
                # A label has the first so many cells.
                used = batch.column("used").to_numpy()[rows]
                scores[np.arange(len(centroids)) >= used[:, None]] = -np.inf
                best = own[rows] = np.argmax(scores, axis=1)
                # A margin over the rounding of scores and distances.
                limit = scores[np.arange(len(rows)), best][:, None] - radius * apart[best] - 1e-7
                seen = (scores >= limit) & (np.arange(len(centroids)) <= best[:, None])
                for r, row in enumerate(rows.tolist()):
                    cells[row] = np.flatnonzero(seen[r]).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own.astype(np.int32)), pa.array(cells, pa.list_(pa.int32()))],
                [*batch.schema.names, "own", "cells"],
            )

    fields = ", ".join(f"`{c}` {t}" for c, t in classes.dtypes)
    return classes.mapInArrow(run, f"{fields}, own int, cells array<int>").select(
        *classes.columns, "own", F.explode("cells").alias("cell")
    ).withColumn("owner", F.col("own") == F.col("cell"))


def _compare(table: pa.Table, rules: Cells) -> pa.Table:
    """``a, b, n`` per class with links in the block: a link and the number of vectors."""
    table = table.combine_chunks()
    block = table["block"].to_numpy()
    unit = _matrix(table["v"].combine_chunks())
    copies = table["copies"].to_numpy()
    first, second = (np.flatnonzero(block == table[c][0].as_py()) for c in ("i", "j"))
    linked = np.zeros((len(unit), len(unit)), bool)
    linked[np.ix_(first, second)] = unit[first] @ unit[second].T >= rules.cosine
    linked |= linked.T
    np.fill_diagonal(linked, False)
    rows = np.flatnonzero(linked.any(axis=1))
    counts = linked[rows].astype(np.float64) @ copies
    keys, first_of, free = table["class"], np.arange(len(unit)), np.zeros(len(unit), bool)
    free[rows] = True
    for first in rows.tolist():
        if not free[first]:
            continue
        free[first], edge = False, np.array([first])
        while len(edge):
            edge = np.flatnonzero(linked[edge].any(axis=0) & free)
            free[edge], first_of[edge] = False, first
    return pa.table({
        "a": keys.take(pa.array(rows)), "b": keys.take(pa.array(first_of[rows])),
        "n": pa.array(counts.astype(np.int64)),
    })


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    rules: Cells | None = None,
) -> DataFrame:
    """Per row ``id, n_links, component_id, kept``.

    Vectors are compared only within a label and with vectors of their own length.  A null
    label, or a vector that is null, empty, zero or holds a null or non-finite component, links
    with nothing and is its own component.  Repeated rows are vectors of their own.  A null id
    is a component's smallest only if all are null.  Other columns are not read.
    """
    rules = rules or Cells()
    source = df.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    ).withColumn("usable", _usable())
    hashes = [F.xxhash64("label", "v"), F.hash("v"), F.hash("label")]
    key = F.concat_ws("-", *[h.cast("string") for h in hashes])
    usable = source.filter("usable").select("id", "label", "v", key.alias("class"))
    alone = source.filter("NOT usable").select(
        F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("component_id"), F.lit(True).alias("kept"),
    )
    classes = stored(
        usable.groupBy("class").agg(
            F.first("label").alias("label"), F.first("v").alias("v"),
            F.count("*").alias("copies"), F.min("id").alias("least"),
        ).withColumn("dim", F.size("v")),
        "vectors",
    )
    total = classes.count()
    if not total:
        return alone
    dim = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()["dim"]
    share = min(1.0, rules.most_sampled / total)
    picked = (
        classes.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("class"), F.lit(1 << 20)) < share * (1 << 20)))
        .select("class", "v").orderBy("class").limit(2 * rules.most_sampled).toPandas()["v"]
    )
    sample = _matrix(pa.array(list(picked), pa.list_(pa.float64()))) if len(picked) else np.eye(1, dim)
    labels = stored(classes.groupBy("label", "dim").agg(F.count("*").alias("used")), "labels")
    k = max(1, min(rules.most_cells, math.ceil(labels.agg(F.max("used")).first()[0] / rules.cell_vectors)))
    centroids = spherical_kmeans(sample, k, rules.rounds, rules.seed)
    cells = F.ceil(F.col("used") / rules.cell_vectors).cast("int")
    counted = classes.drop("least").join(
        broadcast_if_small(labels.withColumn("used", F.least(cells, F.lit(k)))), ["label", "dim"]
    )
    placed = stored(_cells(counted, centroids, rules), "cells")
    groups = ["label", "dim", "cell"]
    owners = F.ceil(F.count_if("owner") / rules.block_rows).cast("int")
    visitors = F.ceil(F.count_if(~F.col("owner")) / (rules.block_rows * rules.visitor_blocks)).cast("int")
    sizes = stored(
        placed.groupBy(*groups).agg(owners.alias("owners"), visitors.alias("visitors"))
        .filter("owners > 0"),
        "cell_sizes",
    )
    # Blocks of owners come first; owners meet every block, visitors those of owners.
    hashed = F.xxhash64("class")
    block = F.when(F.col("owner"), F.pmod(hashed, F.col("owners"))).otherwise(
        F.col("owners") + F.pmod(hashed, F.greatest("visitors", F.lit(1)))
    )
    met = F.col("owners") + F.when(F.col("owner"), F.col("visitors")).otherwise(0)
    dealt = (
        placed.join(broadcast_if_small(sizes), groups)
        .withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), met - 1)))
        .select(*groups, "class", "v", "copies", "block",
                F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    found = stored(
        dealt.groupBy(*groups, "i", "j")
        .applyInArrow(lambda table: _compare(table, rules), "a string, b string, n long"),
        "vector_links",
    )
    members = connected_components(found).select(F.col("node").alias("class"), "component")
    labelled = stored(members.join(classes.select("class", "least"), "class"), "vector_members")
    parts = max(1, math.isqrt(labelled.count()))
    smallest = with_least(labelled, "component", "least", "smallest", parts)
    counts = found.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    answer = stored(
        classes.select("class", "least", "copies")
        .join(counts, "class", "left")
        .join(smallest.select("class", "smallest"), "class", "left")
        .select(
            "class", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("smallest", "least").alias("component_id"), "copies",
        ),
        "vector_verdicts",
    )
    rows = classes.agg(F.sum("copies")).first()[0]
    joined = join_classes(usable.select("id", "class"), answer, "copies", rows)
    return joined.select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    ).unionByName(alone)
