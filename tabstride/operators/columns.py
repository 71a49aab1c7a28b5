"""Column selection, row predicates and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstride.constants import (
    ACTIVE_BELOW,
    DEFAULT_ID_COLUMNS,
    NET_THRESHOLD,
    SPARSE_ACTIVITY_COLUMNS,
)
from tabstride.functions import column_value, named, to_double


def select_features(df: DataFrame, feats: Sequence[str]) -> DataFrame:
    """The feature columns in the given order; an absent one is an error."""
    missing = [f for f in feats if f not in df.columns]
    if missing:
        raise ValueError(f"Missing required feature columns: {missing}")
    return df.select(*map(named, feats))


def drop_columns(df: DataFrame, cols: Sequence[str] = SPARSE_ACTIVITY_COLUMNS) -> DataFrame:
    """``df`` without ``cols``; an unknown name is an error."""
    unknown = [c for c in cols if c not in df.columns]
    if unknown:
        raise ValueError(f"Columns not found: {unknown}")
    return df.drop(*cols)


def drop_sparse_columns(df: DataFrame, max_null_frac: float) -> DataFrame:
    """Drop the columns whose share of missing values is above ``max_null_frac``."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(missing(df, c)).alias(f"m_{i}") for i, c in enumerate(df.columns)],
    ).first()
    limit = max_null_frac * counts["rows"]
    sparse = [c for i, c in enumerate(df.columns) if counts[f"m_{i}"] > limit]
    return df.drop(*sparse)


def missing(df: DataFrame, c: str) -> Column:
    """True for null, and for NaN in a floating column."""
    if dict(df.dtypes)[c] in ("double", "float"):
        return named(c).isNull() | F.isnan(named(c))
    return named(c).isNull()


def literal_table(*rows: Mapping[str, Column]) -> Column:
    """Generator of a few rows with the same named fields, computed from one input row."""
    return F.inline(F.array(*[F.struct(*[c.alias(k) for k, c in r.items()]) for r in rows]))


def is_missing(df: DataFrame, c: str, out: str = "is_missing") -> DataFrame:
    """Add the missing flag of column ``c``."""
    return df.withColumn(out, missing(df, c))


def head(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """First ``n`` rows in ``order``."""
    return df.orderBy(*order).limit(n)


def append_columns(df: DataFrame, derived: Column) -> DataFrame:
    """Side-by-side concatenation of each row with the fields of a derived struct."""
    return df.withColumn("_derived", derived).select(*df.columns, "_derived.*")


def to_numeric_coerce(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """Text column to double; text that is no number becomes null."""
    return df.withColumn(out or c, to_double(c))


def filter_relation(df: DataFrame, rel: str = "=", c: str = "standard_relation") -> DataFrame:
    """Keep rows with the given measurement relation; a null relation is dropped."""
    return df.filter(F.col(c) == rel)


def label_threshold(
    df: DataFrame,
    c: str = "standard_value",
    t: float = ACTIVE_BELOW,
    inclusive: bool = False,
    out: str = "active",
) -> DataFrame:
    """1 when the value is below ``t`` (or at it, if ``inclusive``), else 0; missing gives 0."""
    value = column_value(c)
    hit = value <= t if inclusive else value < t
    return df.withColumn(out, F.when(hit, 1).otherwise(0))


def filter_labelled(df: DataFrame, label: str = "active") -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def project_prepared(
    df: DataFrame,
    keep: Sequence[str] = (),
    features: str = "scaledFeatures",
    label: str = "active",
) -> DataFrame:
    """``features`` and integer ``label``, with any key columns in front."""
    return df.select(
        *keep, F.col(features).alias("features"), F.col(label).cast("int").alias("label")
    )


def apply_threshold(
    df: DataFrame,
    prob: str = "prob_active",
    t: float = NET_THRESHOLD,
    out: str = "pred_active",
) -> DataFrame:
    """1 when the probability is at or above ``t``, else 0; a missing one gives 0."""
    return df.withColumn(out, F.when(column_value(prob) >= F.lit(float(t)), 1).otherwise(0))


def positive_prob(df: DataFrame, out: str = "prob_active", vector: str = "probability") -> DataFrame:
    """Probability of class 1 from a probability vector."""
    return df.withColumn(out, vector_to_array(vector)[1])


def id_columns(df: DataFrame, id_col: str | None = None) -> list[str]:
    """The explicit id if present, else every known id column that is present."""
    if id_col and id_col in df.columns:
        return [id_col]
    return [c for c in DEFAULT_ID_COLUMNS if c in df.columns]


def passthrough_ids(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Scored output: ids, probability and decision."""
    return df.select(*id_columns(df, id_col), "prob_active", "pred_active")
