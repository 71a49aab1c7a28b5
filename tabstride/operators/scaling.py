"""Fitted statistics: assemble, scale, impute."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstride.functions import column_value, fill_missing, standard_score
from tabstride.operators.columns import literal_table
from tabstride.operators.quantiles import median_stats


@dataclass(frozen=True)
class FittedScaler:
    """Mean and standard deviation per feature; a few numbers, whatever the data size."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (i, f, float(m), float(s))
            for i, (f, m, s) in enumerate(zip(self.features, self.means, self.stds))
        ]
        return spark.createDataFrame(
            rows, "position int, feature string, mean double, std double"
        ).coalesce(1)

    @staticmethod
    def from_df(df: DataFrame) -> FittedScaler:
        rows = df.orderBy("position").collect()
        return FittedScaler(
            tuple(r["feature"] for r in rows),
            tuple(r["mean"] for r in rows),
            tuple(r["std"] for r in rows),
        )


def assemble(
    df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    """Columns to one vector; ``handle_invalid`` is ``error``, ``skip`` or ``keep``."""
    assembler = VectorAssembler(
        inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid
    )
    return assembler.transform(df)


def scaler_stats(df: DataFrame, cols: Sequence[str], ddof: int = 1) -> DataFrame:
    """``feature, mean, std`` of every column in one pass; missing values are left out.

    ``ddof`` 1 divides by n-1, 0 by n.
    """
    spread = F.stddev_samp if ddof == 1 else F.stddev_pop
    wide = df.select(*[column_value(c).alias(f"x{i}") for i, c in enumerate(cols)])
    row = wide.agg(
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(cols))],
        *[spread(f"x{i}").alias(f"s{i}") for i in range(len(cols))],
    )
    rows = [
        {"position": F.lit(i), "feature": F.lit(c), "mean": F.col(f"m{i}"), "std": F.col(f"s{i}")}
        for i, c in enumerate(cols)
    ]
    return row.select(literal_table(*rows))


def fit_scaler(df: DataFrame, cols: Sequence[str], ddof: int = 1) -> FittedScaler:
    """Fit on all rows of ``df``; pass the train part to fit on train rows only."""
    scaler = FittedScaler.from_df(scaler_stats(df, cols, ddof))
    absent = [f for f, m in zip(scaler.features, scaler.means) if m is None]
    if absent:
        raise ValueError(f"No values to fit in columns: {absent}")
    # One row has no n-1 deviation; treat it as constant.
    return FittedScaler(
        scaler.features, scaler.means, tuple(0.0 if s is None else s for s in scaler.stds)
    )


def scaled(x: Column | str, mean: float, std: float, constant: str = "zero") -> Column:
    """Standard score; for a constant feature either 0 or the centred value.

    ``constant="zero"`` maps every value to 0, ``"one"`` divides by 1.
    """
    if std > 0:
        return standard_score(x, mean, std)
    if constant == "one":
        return standard_score(x, mean, 1.0)
    column = F.col(x) if isinstance(x, str) else x
    return F.when(column.isNotNull(), F.lit(0.0))


def apply_fitted(
    df: DataFrame,
    scaler: FittedScaler,
    constant: str = "zero",
    suffix: str = "",
) -> DataFrame:
    """Scale the features in place, or into ``<name><suffix>`` columns.

    The fitted numbers are constants of the plan, so no join is needed.
    """
    return df.withColumns(
        {
            f + suffix: scaled(column_value(f), m, s, constant)
            for f, m, s in zip(scaler.features, scaler.means, scaler.stds)
        }
    )


def impute(
    df: DataFrame, feats: Sequence[str], scaler: FittedScaler | None = None
) -> DataFrame:
    """Fill null and NaN with the fitted means, by position.

    Without fitted means for exactly these many features the medians of ``df`` are used.
    """
    if scaler is not None and len(scaler.means) == len(feats):
        fills = list(scaler.means)
    else:
        medians = {r["column"]: r["median"] for r in median_stats(df, feats).collect()}
        fills = [medians.get(f) for f in feats]
    return df.withColumns(
        {f: fill_missing(f, v) if v is not None else column_value(f) for f, v in zip(feats, fills)}
    )
