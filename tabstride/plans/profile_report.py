"""Exploratory profile of a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache, partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstride.functions import column_value
from tabstride.operators.profile import (
    auto_bins_from,
    box_stats,
    corr_matrix,
    count_distinct,
    describe_numeric,
    describe_string,
    histograms,
    null_counts,
    row_count,
    schema_profile,
    share_by_category,
    value_counts,
)
from tabstride.session import materialize, stored


def profile_report(
    df: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str] = (),
    text: str | None = None,
    label: str | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """The tables of a profile by name; call one to compute it.

    The numeric summary covers all columns at once and also sets the histograms' bins, so
    it is computed only once; one more read then counts the bins of all histograms.  These
    reads take the numeric columns from a copy that is stored once.  Store ``df`` first if it
    is costly and other tables are wanted too.
    """

    @cache
    def numbers() -> DataFrame:
        return stored(df.select(*[column_value(c).alias(c) for c in dict.fromkeys(numeric)]))

    @cache
    def summary() -> DataFrame:
        return materialize(describe_numeric(numbers(), numeric))

    @cache
    def all_bins() -> DataFrame:
        stats = {r["column"]: r for r in summary().collect()}  # one row per column
        bins = {c: (auto_bins_from(s), s["min"], s["max"]) for c, s in stats.items()}
        return materialize(histograms(numbers(), bins))

    def auto_histogram(c: str) -> DataFrame:
        return all_bins().filter(F.col("column") == c).drop("column")

    report = {
        "row_count": partial(row_count, df),
        "null_counts": partial(null_counts, df),
        "schema": partial(schema_profile, df),
        "describe": summary,
        "correlation": partial(corr_matrix, df, numeric),
    }
    for c in numeric:
        report[f"histogram.{c}"] = partial(auto_histogram, c)
    for c in categories:
        report[f"values.{c}"] = partial(value_counts, df, c)
        report[f"share.{c}"] = partial(share_by_category, df, c)
    if text is not None:
        report[f"describe.{text}"] = partial(describe_string, df, text)
        report[f"distinct.{text}"] = partial(count_distinct, df, text)
    if label is not None:
        report[f"share.{label}"] = partial(share_by_category, df, label)
        report[f"box.{label}"] = partial(box_stats, df, numeric, label)
    return report
