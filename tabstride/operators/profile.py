"""Table profiling: counts, summaries, frequencies, histograms, boxes, correlation."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstride.functions import column_value
from tabstride.operators.columns import literal_table, missing
from tabstride.operators.quantiles import beside, column_stats, ranked_stats, stack_columns
from tabstride.session import materialize

QUARTILES = [0.25, 0.5, 0.75]
WHISKER = 1.5


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def _per_column(one_row: DataFrame, names: Sequence[str], fields: dict[str, list[Column]]):
    """Turn a one-row wide aggregate into one row per name."""
    rows = [
        {"column": F.lit(name), **{f: cols[i] for f, cols in fields.items()}}
        for i, name in enumerate(names)
    ]
    return one_row.select(literal_table(*rows))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass."""
    row = df.agg(*[F.count_if(missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)])
    return _per_column(
        row, df.columns, {"n_missing": [F.col(f"m{i}") for i in range(len(df.columns))]}
    )


def schema_profile(df: DataFrame) -> DataFrame:
    """Column name, type and present count, in column order."""
    row = df.agg(*[F.count_if(~missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    size = range(len(df.columns))
    return _per_column(
        row,
        df.columns,
        {
            "position": [F.lit(i) for i in size],
            "type": [F.lit(t) for _, t in df.dtypes],
            "n_present": [F.col(f"n{i}") for i in size],
        },
    )


def describe_numeric(df: DataFrame, cols: Sequence[str], **options) -> DataFrame:
    """count, mean, std (n-1), min, quartiles (linear) and max of every column."""
    q = F.col("quantiles")
    return column_stats(df, cols, QUARTILES, **options).select(
        "column",
        F.col("n").alias("count"),
        "mean",
        "std",
        "min",
        q[0].alias("q25"),
        q[1].alias("q50"),
        q[2].alias("q75"),
        "max",
    )


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """Frequency of every present value, most frequent first, ties by value."""
    return (
        df.filter(~missing(df, c))
        .groupBy(c)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), c)
    )


def top_categories(df: DataFrame, c: str, k: int) -> DataFrame:
    return value_counts(df, c).limit(k)


def describe_string(df: DataFrame, c: str) -> DataFrame:
    """count, number of distinct values, most frequent value (ties: least) and its count."""
    best = F.min(F.struct((-F.col("n")).alias("key"), F.col(c).alias("value")))
    groups = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        F.count(F.lit(1)).alias("unique"),
        best.alias("best"),
    ).select(
        "count", "unique", F.col("best.value").alias("top"), (-F.col("best.key")).alias("freq")
    )


def count_distinct(df: DataFrame, c: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(c) if approximate else F.count_distinct(c)
    return df.agg(count.alias("n_distinct"))


def count_by_year(df: DataFrame, year: str = "document_year") -> DataFrame:
    return df.filter(F.col(year).isNotNull()).groupBy(year).agg(F.count(F.lit(1)).alias("n"))


def year_span(df: DataFrame, year: str = "document_year") -> DataFrame:
    """First, last and busiest year (ties: earliest)."""
    busiest = F.min(F.struct((-F.col("n")).alias("key"), F.col(year).alias("year")))
    return count_by_year(df, year).agg(
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        busiest["year"].alias("peak_year"),
    )


def share_by_category(df: DataFrame, c: str) -> DataFrame:
    """Frequency of every present value and its share of all present values."""
    groups = df.filter(~missing(df, c)).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    total = groups.agg(F.sum("n").alias("total"))
    return groups.crossJoin(F.broadcast(total)).select(
        c, "n", (F.col("n") / F.col("total")).alias("share")
    )


def missing_counts(df: DataFrame, c: str) -> DataFrame:
    """How many rows are and are not missing in ``c``."""
    return df.groupBy(missing(df, c).alias("is_missing")).agg(F.count(F.lit(1)).alias("n"))


def _moment_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Task function: counts, sums, squares and products over pairwise complete rows."""
    total = None
    for pdf in batches:
        x = pdf.to_numpy(float)
        present = ~np.isnan(x)
        x, m = np.where(present, x, 0.0), present.astype(float)
        sums = np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        total = sums if total is None else total + sums
    if total is not None:
        n, first, square, product = total
        a, b = np.indices(n.shape)
        columns = [a, b, n, first, first.T, square, square.T, product]
        yield pd.DataFrame(np.column_stack([c.ravel() for c in columns]), columns=_MOMENTS)


_MOMENTS = ["a", "b", "n", "sum_a", "sum_b", "sq_a", "sq_b", "prod"]


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation over pairwise complete rows as ``(a, b, r)``.

    Null where a column is constant over the pair's rows.  A name listed twice counts once.
    One pass finds the means; one pass multiplies the centred columns batch by batch, and
    each task hands on one small matrix.
    """
    names = list(dict.fromkeys(cols))
    wide = df.select(*[column_value(c).alias(c) for c in names])
    means = wide.agg(*[F.avg(c).alias(c) for c in names]).first()
    centred = wide.select(*[(F.col(c) - F.lit(means[c] or 0.0)).alias(c) for c in names])
    sums = (
        centred.mapInPandas(_moment_sums, ", ".join(f"{c} double" for c in _MOMENTS))
        .groupBy(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"))
        .agg(*[F.sum(c).alias(c) for c in _MOMENTS[2:]])
    )
    n = F.col("n")
    spread = {s: F.col(f"sq_{s}") - F.col(f"sum_{s}") ** 2 / n for s in "ab"}
    # What is left of a constant after centring is rounding noise.
    varies = [spread[s] > 1e-12 * F.col(f"sq_{s}") for s in "ab"]
    shared = F.col("prod") - F.col("sum_a") * F.col("sum_b") / n
    r = F.when(
        (n > 1) & varies[0] & varies[1],
        F.when(F.col("a") == F.col("b"), F.lit(1.0)).otherwise(
            shared / F.sqrt(spread["a"]) / F.sqrt(spread["b"])
        ),
    )
    name = F.array(*[F.lit(c) for c in names])
    return sums.select(name[F.col("a")].alias("a"), name[F.col("b")].alias("b"), r.alias("r"))


def histogram(
    df: DataFrame,
    c: str,
    bins: int | None = None,
    extent: tuple[float, float] | None = None,
    keep_empty: bool | None = None,
) -> DataFrame:
    """Counts in equal-width bins between min and max.

    Bins are closed on the left, the last one on both sides.  Without ``bins`` number and
    extent come from :func:`describe_numeric`.  As a long tail can make that number huge, only
    bins that hold values are then returned; given ``bins`` are returned with the empty ones
    unless ``keep_empty`` says otherwise.  ``extent`` saves the pass that finds min and max.
    A constant column gets a range of width one around it.
    """
    if keep_empty is None:
        keep_empty = bins is not None
    if bins is None:
        stats = describe_numeric(df, [c]).first()
        bins, extent = auto_bins_from(stats), (stats["min"], stats["max"]) if stats else None
    values = df.select(column_value(c).alias("x")).filter("x IS NOT NULL")
    if extent is None:
        found = values.agg(F.min("x"), F.max("x")).first()
        extent = (found[0], found[1])
    kind = "int" if keep_empty else "bigint"
    if extent[0] is None:
        return df.sparkSession.createDataFrame(
            [], f"bin {kind}, bin_start double, bin_end double, n bigint"
        )
    lo, hi = map(float, extent)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (F.lit(hi) - F.lit(lo)) / F.lit(bins)
    place = F.least(F.floor((F.col("x") - F.lit(lo)) / width), F.lit(bins - 1).cast("bigint"))
    placed = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    if keep_empty:
        every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
        placed = every.join(placed, "bin", "left")
    return placed.select(
        F.col("bin").cast(kind).alias("bin"),
        (F.lit(lo) + F.col("bin") * width).alias("bin_start"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def histograms(df: DataFrame, bins: Mapping[str, tuple[int, float, float]]) -> DataFrame:
    """``column, bin, bin_start, bin_end, n`` of many columns in one read.

    ``bins`` gives number, least and greatest value of each column; only bins that hold values
    are returned.  Otherwise as :func:`histogram`.
    """
    known = {c: b for c, b in bins.items() if b[1] is not None}
    if not known:
        return df.sparkSession.createDataFrame(
            [], "column string, bin bigint, bin_start double, bin_end double, n bigint"
        )
    edges = [
        (n, lo - 0.5, hi + 0.5) if lo == hi else (n, float(lo), float(hi)) for n, lo, hi in known.values()
    ]
    number, low, high = (F.array(*[F.lit(e[k]) for e in edges]) for k in range(3))
    slot = F.col("slot")
    width = (high[slot] - low[slot]) / number[slot]
    values = stack_columns(
        df.select(*[column_value(c).alias(f"v{i}") for i, c in enumerate(known)]), [], ["slot", "x"],
        *[(F.lit(i), F.col(f"v{i}")) for i in range(len(known))],
    ).filter("x IS NOT NULL")
    place = F.least(F.floor((F.col("x") - low[slot]) / width), (number[slot] - 1).cast("bigint"))
    placed = values.groupBy("slot", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return placed.select(
        F.array(*[F.lit(c) for c in known])[slot].alias("column"),
        "bin",
        (low[slot] + F.col("bin") * width).alias("bin_start"),
        (low[slot] + (F.col("bin") + 1) * width).alias("bin_end"),
        "n",
    )


def auto_bins(df: DataFrame, c: str) -> int:
    """Bin count from the narrower of the Sturges and Freedman-Diaconis widths."""
    return auto_bins_from(describe_numeric(df, [c]).first())


def auto_bins_from(stats) -> int:
    """Bin count from one row of :func:`describe_numeric`; 1 for an empty or constant column."""
    if stats is None or stats["count"] == 0 or stats["max"] == stats["min"]:
        return 1
    n, extent = stats["count"], stats["max"] - stats["min"]
    width = extent / (log2(n) + 1)
    spread = 2.0 * (stats["q75"] - stats["q25"]) / n ** (1.0 / 3.0)
    if spread > 0:
        width = min(width, spread)
    return ceil(extent / width)


def box_stats(df: DataFrame, cols: Sequence[str], by: str, **options) -> DataFrame:
    """Quartiles, whiskers and outlier count of each column per value of ``by``.

    A whisker ends at the last datum within 1.5 interquartile ranges of the box.
    """
    boxes, points = ranked_stats(df, cols, QUARTILES, by=[by], fence=WHISKER, **options)
    q = F.col("quantiles")
    boxes = materialize(
        boxes.select(by, "column", "n", *[q[k].alias(c) for k, c in enumerate(["q1", "median", "q3"])])
    )
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    # A point is a value or a run of values that lies on one side of each fence.
    inside = F.col("min").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        beside(points, boxes, [by, "column"])
        .groupBy(by, "column", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("min"))).alias("in_lo"),
            F.max(F.when(inside, F.col("max"))).alias("in_hi"),
            F.coalesce(F.sum(F.when(~inside, F.col("copies"))), F.lit(0)).alias("n_outliers"),
        )
        .select(
            by,
            "column",
            "n",
            "q1",
            "median",
            "q3",
            F.least("in_lo", "q1").alias("whisker_lo"),
            F.greatest("in_hi", "q3").alias("whisker_hi"),
            "n_outliers",
        )
    )
