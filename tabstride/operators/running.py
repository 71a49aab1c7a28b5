"""Cumulative sums over an ordered table of any size."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstride.session import broadcast_if_small, materialize

# Rows of an ordered range, which one task sums.
SINGLE_TASK_ROWS = 1_000_000


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str],
    keys: Sequence[str] = (),
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``cum_<name>`` (inclusive, in ``order``, per ``keys``) for each name in ``sums``.

    The input is stored once, counted and split into ordered ranges of about
    ``single_task_rows`` rows; each range is summed on its own and shifted by the total of the
    ranges before it, so no task ever holds more than about one range.  A single range has
    nothing before it and is summed as it is stored.  Rows should be unique in
    ``(keys, order)``: group them first.
    """
    stored = materialize(df)
    ranges = max(1, ceil(stored.count() / single_task_rows))
    if ranges == 1:
        running = (
            Window.partitionBy(*keys)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return stored.select("*", *[F.sum(s).over(running).alias(f"cum_{s}") for s in sums])
    # The range number is stored with the row, so both reads below agree on it.
    ranged = materialize(
        stored.repartitionByRange(
            ranges, *[F.col(k) for k in keys], *order
        ).withColumn("range_no", F.spark_partition_id())
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy("range_no")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = ranged.groupBy(*keys, "range_no").agg(
        *[F.sum(s).alias(f"sum_{s}") for s in sums]
    ).select(
        *[F.col(k).alias(f"off_{k}") for k in keys],
        F.col("range_no").alias("off_range_no"),
        *[F.coalesce(F.sum(f"sum_{s}").over(before), F.lit(0)).alias(f"off_{s}") for s in sums],
    )
    inside = (
        Window.partitionBy(*keys, "range_no")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.select("*", *[F.sum(s).over(inside).alias(f"cum_{s}") for s in sums])
    same_range = F.col("range_no") == F.col("off_range_no")
    for k in keys:
        same_range = same_range & F.col(k).eqNullSafe(F.col(f"off_{k}"))
    return local.join(broadcast_if_small(offsets), same_range).select(
        *df.columns,
        *[(F.col(f"cum_{s}") + F.col(f"off_{s}")).alias(f"cum_{s}") for s in sums],
    )
