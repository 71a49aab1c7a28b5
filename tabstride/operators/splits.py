"""Deterministic splits, folds and samples.

Membership depends only on the seed and a row key, never on the file or partition layout.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstride.constants import FOLDS, SEED, TEST_RATIO
from tabstride.functions import hash_bucket, hash_order
from tabstride.functions.scalars import HASH_BUCKETS
from tabstride.operators.metrics import false_negatives, false_positives
from tabstride.operators.running import SINGLE_TASK_ROWS, running_totals
from tabstride.session import broadcast_if_small, materialize

# Hex digits of the hash used for bracketing: 52 bits, exact in a double.
_HEAD_DIGITS = 13
_HEAD_RANGE = float(16**_HEAD_DIGITS)
# Share of all hashes, on either side of a cut's expected place, that is kept in the first read.
NEAR = Fraction(1, 64)


def is_test(key: Column | str, test_ratio: float = TEST_RATIO, seed: int = SEED) -> Column:
    """True for about ``test_ratio`` of all keys."""
    first_test = round((1 - test_ratio) * HASH_BUCKETS)
    return hash_bucket(key, seed) >= F.lit(first_test)


def random_split(
    df: DataFrame, key: str = "id", test_ratio: float = TEST_RATIO, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the row key; no shuffle."""
    test = is_test(key, test_ratio, seed)
    return df.filter(~test), df.filter(test)


def kfold(
    df: DataFrame, key: str = "id", k: int = FOLDS, seed: int = SEED, out: str = "fold"
) -> DataFrame:
    """Add a fold number in ``[0, k)``."""
    return df.withColumn(out, hash_bucket(key, seed, k).cast("int"))


def stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "id",
    test_ratio: float = TEST_RATIO,
    seed: int = SEED,
    out: str = "is_test",
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add a flag that marks exactly ``floor(n * test_ratio)`` rows of each label.

    Within a label the rows with the smallest hashes form the test part.  Hashes are uniform,
    so the cut lies near ``test_ratio`` of their range: one read of label and key counts the rows
    below and above and keeps the few hashes near it, from which sizes and cuts follow; the
    flag is set in the read of the result.  Only labels whose cut lies farther off, as it can
    with less than about 65,000 rows, are read once more.  The rows themselves are neither sorted
    nor shuffled.  ``key`` must be unique; equal keys always land on the same side.
    """
    rows = df.select(F.col(label).alias("stratum"), hash_order(key, seed).alias("point"))
    ratio = Fraction(str(test_ratio)).limit_denominator(10**6)
    point = F.col("point")
    below, above = point < _hash_at(ratio - NEAR), point > _hash_at(ratio + NEAR)
    counts = materialize(
        rows.withColumn("point", F.when(below, "").when(above, "g").otherwise(point))
        .groupBy("stratum", "point")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    cuts = materialize(_cuts(counts, ratio, single_task_rows))
    lost = cuts.filter("cut IS NULL").select(F.col("stratum").alias("_stratum"))
    if not lost.isEmpty():
        few = rows.join(
            broadcast_if_small(lost), F.col("stratum").eqNullSafe(F.col("_stratum")), "left_semi"
        )
        whole = few.groupBy("stratum", "point").agg(F.count(F.lit(1)).alias("copies"))
        found = _cuts(materialize(whole), ratio, single_task_rows, narrow=False)
        cuts = materialize(cuts.filter("cut IS NOT NULL").unionByName(found))
    placed = df.join(
        broadcast_if_small(cuts.select(F.col("stratum").alias("_stratum"), "cut")),
        F.col(label).eqNullSafe(F.col("_stratum")),
    )
    return placed.select(*df.columns, (hash_order(key, seed) <= F.col("cut")).alias(out))


def _hash_at(share: Fraction) -> Column:
    """The hash below which about ``share`` of all hashes lie; '' and 'g' lie outside of all."""
    if 0 < share < 1:
        return F.lit(f"{int(share * 16**_HEAD_DIGITS):0{_HEAD_DIGITS}x}")
    return F.lit("" if share <= 0 else "g")


def _cuts(
    counts: DataFrame, ratio: Fraction, single_task_rows: int, narrow: bool = True
) -> DataFrame:
    """Per stratum the hash of the last test row, '' for no test row, null if it is not among the points.

    '' and 'g' among the points stand for the rows below and above the others.  The cut lies
    within ``4 / sqrt(n)`` of its expected place, eight deviations, so with ``narrow`` only the
    points there are ordered.
    """
    sizes = counts.groupBy("stratum").agg(F.sum("copies").alias("n")).select(
        F.col("stratum").alias("s_stratum"), "n",
        F.expr(f"n * {ratio.numerator} div {ratio.denominator}").alias("take"),
    )
    placed = counts.join(
        broadcast_if_small(materialize(sizes)), F.col("stratum").eqNullSafe(F.col("s_stratum"))
    )
    if narrow:
        head = F.conv(F.substring("point", 1, _HEAD_DIGITS), 16, 10).cast("double") / _HEAD_RANGE
        off, reach = head - F.lit(float(ratio)), F.lit(4.0) / F.sqrt("n")
        point = F.col("point")
        kept = F.when(point.isin("", "g"), point).when(off < -reach, "").when(off > reach, "g")
        placed = placed.withColumn("point", F.coalesce(kept, point))
    points = placed.groupBy("stratum", "take", "point").agg(F.sum("copies").alias("copies"))
    ranked = running_totals(points, [F.col("point")], ["copies"], ["stratum"], single_task_rows)
    last_in = F.max(F.when(F.col("cum_copies") <= F.col("take"), F.col("point")))
    first_out = F.min(F.when(F.col("cum_copies") > F.col("take"), F.col("point")))
    edge = ranked.groupBy("stratum", "take").agg(
        last_in.alias("last_in"), first_out.alias("first_out")
    )
    # The cut is known only when the rows on both sides of it were kept apart.
    found = (
        F.when(F.col("take") == 0, "")
        .when(F.col("first_out").isin("", "g") | (F.col("last_in") == ""), None)
        .otherwise(F.coalesce("last_in", F.lit("")))
    )
    return edge.select("stratum", found.alias("cut"))


def label_sample(
    df: DataFrame, most: int, key: str = "id", seed: int = SEED
) -> DataFrame:
    """At most ``most`` rows, those with the smallest key hashes: a bounded set to fit on.

    It is stored, since a fit reads its rows many times.
    """
    return materialize(df.orderBy(hash_order(key, seed), key).limit(most))


def sample_errors(
    df: DataFrame,
    n: int = 5,
    key: str = "id",
    label: str = "label",
    prediction: str = "prediction",
    seed: int = SEED,
) -> DataFrame:
    """Up to ``n`` seeded random rows of each error kind."""
    order = hash_order(key, seed)
    wrong_positive = false_positives(df, label, prediction).orderBy(order).limit(n)
    wrong_negative = false_negatives(df, label, prediction).orderBy(order).limit(n)
    return wrong_positive.withColumn("error", F.lit("false_positive")).unionByName(
        wrong_negative.withColumn("error", F.lit("false_negative"))
    )
