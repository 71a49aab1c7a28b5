"""Scalar column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BUCKETS = 10_000


def named(c: str) -> Column:
    """The column of exactly this name, which may hold dots and other signs."""
    return F.col("`" + c.replace("`", "``") + "`")


def _col(c: Column | str) -> Column:
    return named(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Number in ``c``, or null where the text is not a number."""
    return _col(c).try_cast("double")


def column_value(c: Column | str) -> Column:
    """Double value of ``c`` with NaN folded into null, so one rule covers both."""
    return F.nanvl(to_double(c), F.lit(None).cast("double"))


def fill_missing(c: Column | str, value: Column | float) -> Column:
    """``c`` with null and NaN replaced by ``value``."""
    fallback = value if isinstance(value, Column) else F.lit(value)
    return F.coalesce(column_value(c), fallback)


def sigmoid(x: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-_col(x)))


def logit(p: Column | str) -> Column:
    return F.ln(_col(p) / (1.0 - _col(p)))


def relu(x: Column | str) -> Column:
    """The positive part; null stays null and NaN stays NaN."""
    return F.when(_col(x).isNotNull(), F.greatest(F.lit(0.0), _col(x)))


def standard_score(x: Column | str, mean: float, std: float) -> Column:
    return (_col(x) - F.lit(float(mean))) / F.lit(float(std))


def hash_order(key: Column | str, seed: int) -> Column:
    """Pseudo-random sort key that depends only on the seed and the row key.

    A null key is an error: such a row would be in no part of a split.
    """
    text = F.coalesce(
        _col(key).cast("string"), F.raise_error(F.lit("null row key")).cast("string")
    )
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def hash_bucket(key: Column | str, seed: int, buckets: int = HASH_BUCKETS) -> Column:
    """Bucket in ``[0, buckets)`` from the first 32 bits of :func:`hash_order`."""
    head = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("bigint")
    return head % F.lit(buckets)
