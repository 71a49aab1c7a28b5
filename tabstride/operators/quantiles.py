"""Exact order statistics with bounded state per task.

A mergeable quantile sketch first brackets every wanted rank.  In the second scan each
value outside the brackets collapses to a count, so only the rows inside the narrow
brackets are shuffled, and the exact ranks are read off running totals of the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstride.functions import column_value
from tabstride.operators.running import SINGLE_TASK_ROWS, running_totals
from tabstride.session import broadcast_if_small, materialize

# Sketch size; ranks are then right to about 1/7000 with high probability.
SKETCH_SIZE = 32_768
# Sketches of this many groups of tasks are merged before the last merge.
MERGE_GROUPS = 256


def stack_columns(wide: DataFrame, by: Sequence[str], names: Sequence[str], *rows) -> DataFrame:
    """One row ``(by..., names...)`` per given row of expressions, for every input row."""
    return wide.select(
        *by, F.stack(F.lit(len(rows)), *[e for row in rows for e in row]).alias(*names)
    )


def match(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of every key with its prefixed twin."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(prefix + k))
    return condition


def beside(df: DataFrame, small: DataFrame, keys: Sequence[str], prefix: str = "k_") -> DataFrame:
    """Each row of ``df`` with the row of ``small`` that has the same keys.

    ``small`` has one row per key, so a single row without keys; it is stored already.
    """
    if not keys:
        return df.crossJoin(F.broadcast(small))
    renamed = small.select(*[F.col(k).alias(prefix + k) for k in keys],
                           *[c for c in small.columns if c not in keys])
    joined = df.join(broadcast_if_small(renamed), match(keys, prefix))
    return joined.drop(*[prefix + k for k in keys])


def column_stats(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    sketch_size: int = SKETCH_SIZE,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Count, mean, std (n-1), min, max and exact quantiles per ``(by..., column)``.

    ``quantiles`` is an array in the order of ``probs`` (which must ascend); between two
    data points the quantile is linear.  Null and NaN are left out.
    """
    return ranked_stats(df, cols, probs, by, sketch_size, single_task_rows)[0]


def ranked_stats(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    sketch_size: int = SKETCH_SIZE,
    single_task_rows: int = SINGLE_TASK_ROWS,
    fence: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The statistics of ``column_stats``, and the grouped points that they were read from.

    Points are rows ``(by..., column, min, max, copies)``, each a value or a run of values
    between brackets.  With ``fence`` no run reaches across a fence, ``fence`` times the distance
    of the first from the last of ``probs`` outside of them, so that what lies within the
    fences is known from the points.  Two reads of ``df``.
    """
    wide = df.select(*by, *[column_value(c).alias(f"v{i}") for i, c in enumerate(cols)])
    sketch = materialize(_brackets(wide, len(cols), probs, by, sketch_size, fence))
    ranked = _rank_rows(wide, len(cols), sketch, probs, by, True, single_task_rows, fence)
    stats = _read_ranks(ranked, sketch, probs, by)
    missed = F.exists("low", lambda v: v.isNull()) | F.exists("high", lambda v: v.isNull())
    if not stats.filter(missed).isEmpty():
        # A bracket missed its rank: keep every distinct value instead.
        ranked = _rank_rows(wide, len(cols), sketch, probs, by, False, single_task_rows, fence)
        stats = _read_ranks(ranked, sketch, probs, by)

    quantiles = []
    for i, p in enumerate(probs):
        low, high = F.col("low")[i], F.col("high")[i]
        part = _position(p) - F.floor(_position(p))
        quantiles.append(F.when(low == high, low).otherwise(low + (high - low) * part))
    n = F.col("n")
    variance = F.when(
        n > 1, F.greatest(F.col("dev2") - F.col("dev") ** 2 / n, F.lit(0.0)) / (n - 1)
    )
    names = F.array(*[F.lit(c) for c in cols])
    points = ranked.select(*by, names[F.col("slot")].alias("column"), "min", "max", "copies")
    summary = stats.select(
        *by,
        names[F.col("slot")].alias("column"),
        "n",
        (F.col("centre") + F.col("dev") / n).alias("mean"),
        F.sqrt(variance).alias("std"),
        "min",
        "max",
        F.array(*quantiles).alias("quantiles"),
    )
    return summary, points


def _position(p: float) -> Column:
    """Zero-based, possibly fractional rank of quantile ``p``."""
    return F.lit(float(p)) * (F.col("n") - 1)


def _brackets(wide, size: int, probs, by, sketch_size: int, fence: float | None) -> DataFrame:
    """``(by..., slot, n, edges, centre)``: two sketch quantiles around each probability.

    With ``fence`` two more brackets follow, of all places where a fence can lie.

    One wide aggregate holds a sketch per column, so no row is multiplied by the columns.
    Sketches are merged in two rounds, so no task takes in those of all tasks.
    """
    slack = 4.0 * 2.446 / sketch_size**0.9433
    wanted = [q for p in probs for q in (max(0.0, p - slack), min(1.0, p + slack))]
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("merge_group")
    slots = range(size)
    sketches = (
        wide.groupBy(*by, group)
        .agg(*[F.kll_sketch_agg_double(f"v{i}", sketch_size).alias(f"part{i}") for i in slots])
        .groupBy(*by)
        .agg(*[F.kll_merge_agg_double(f"part{i}", sketch_size).alias(f"whole{i}") for i in slots])
    )
    rows = [
        F.struct(F.lit(i).alias("slot"), F.col(f"whole{i}").alias("whole")) for i in slots
    ]
    levels = F.array(*[F.lit(float(q)) for q in [*wanted, 0.5]])
    # A column without a value has an empty sketch, which has no quantiles.
    n = F.kll_sketch_get_n_double("whole")
    read = sketches.select(*by, F.inline(F.array(*rows))).select(
        *by,
        "slot",
        n.alias("n"),
        F.when(n > 0, F.kll_sketch_get_quantile_double("whole", levels)).alias("levels"),
    ).filter("n > 0")
    middle = F.col("levels")[len(wanted)]
    # A few rows are ranked whole; the sketch says nothing about neighbours then.
    narrow = F.col("n") > sketch_size
    ends = [F.col("levels")[i] for i in range(len(wanted))]
    if fence is not None:
        first, last = ends[:2], ends[-2:]
        spread = [last[0] - first[1], last[1] - first[0]]
        ends = [
            *ends,
            first[0] - fence * spread[1], first[1] - fence * F.greatest(spread[0], F.lit(0.0)),
            last[0] + fence * F.greatest(spread[0], F.lit(0.0)), last[1] + fence * spread[1],
        ]
    edges = [
        F.when(narrow, end).otherwise(F.lit(float("inf") if i % 2 else float("-inf")))
        for i, end in enumerate(ends)
    ]
    return read.select(
        *by,
        "slot",
        "n",
        F.array(*edges).alias("edges"),
        F.when(F.abs(middle) < float("inf"), middle).otherwise(F.lit(0.0)).alias("centre"),
    )


def _rank_rows(wide, size, sketch, probs, by, narrow: bool, single_task_rows, fence) -> DataFrame:
    """Distinct points with their number of copies and the running total of copies.

    A value outside all brackets is folded into the gap after the bracket below it.
    """
    slots = [F.col("slot") == i for i in range(size)]
    frames = materialize(
        sketch.groupBy(*by).agg(
            F.array(*[F.max(F.when(s, F.col("edges"))) for s in slots]).alias("all_edges"),
            F.array(*[F.max(F.when(s, F.col("centre"))) for s in slots]).alias("centres"),
        )
    )
    # The brackets are looked up by slot, so the code per value does not grow with the columns.
    values = stack_columns(
        beside(wide, frames, by),
        [*by, "all_edges", "centres"],
        ["slot", "value"],
        *[(F.lit(i), F.col(f"v{i}")) for i in range(size)],
    ).filter("value IS NOT NULL")
    v, start = F.col("value"), F.lit(float("-inf"))
    inside, passed = F.lit(not narrow), start
    if narrow:
        edges = F.col("all_edges")[F.col("slot")]
        brackets = len(probs) + (0 if fence is None else 2)
        pairs = [(edges[2 * p], edges[2 * p + 1]) for p in range(brackets)]
        for low, high in pairs:
            inside = inside | v.between(low, high)
        passed = F.greatest(start, *[F.when(high < v, high) for _, high in pairs])
    counts = (
        values.select(
            *by,
            "slot",
            "value",
            F.when(inside, v).otherwise(passed).alias("point"),
            F.when(inside, 0).otherwise(1).alias("gap"),
            (v - F.col("centres")[F.col("slot")]).alias("deviation"),
        )
        .groupBy(*by, "slot", "point", "gap")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.sum("deviation").alias("dev"),
            F.sum(F.col("deviation") * F.col("deviation")).alias("dev2"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    return running_totals(
        counts, [F.col("point"), F.col("gap")], ["copies"], [*by, "slot"], single_task_rows
    )


def _read_ranks(ranked, sketch, probs, by) -> DataFrame:
    """Moments and the values at the ranks around each probability; null where missed."""
    keys = [*by, "slot"]
    placed = beside(ranked, sketch.select(*keys, "n", "centre"), keys)
    first = F.col("cum_copies") - F.col("copies")

    def at_rank(rank: Column) -> Column:
        hit = (F.col("gap") == 0) & (first <= rank) & (rank < F.col("cum_copies"))
        return F.max(F.when(hit, F.col("point")))

    return placed.groupBy(*keys, "n", "centre").agg(
        F.array(*[at_rank(F.floor(_position(p))) for p in probs]).alias("low"),
        F.array(*[at_rank(F.ceil(_position(p))) for p in probs]).alias("high"),
        F.sum("dev").alias("dev"),
        F.sum("dev2").alias("dev2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )


def median_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact median of each column as ``(column, median)``."""
    stats = column_stats(df, cols, [0.5])
    return stats.select("column", F.col("quantiles")[0].alias("median"))
