"""Raw table to a labelled, scaled, assembled training set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabstride.constants import ACTIVE_BELOW, DEFAULT_FEATURES
from tabstride.operators.columns import (
    filter_labelled,
    label_threshold,
    project_prepared,
    select_features,
)
from tabstride.operators.scaling import FittedScaler, apply_fitted, assemble, fit_scaler


def prepare_columns(
    df: DataFrame,
    threshold: float = ACTIVE_BELOW,
    feats: Sequence[str] = tuple(DEFAULT_FEATURES),
    keep: Sequence[str] = ("id",),
    value_col: str = "standard_value",
    scaler: FittedScaler | None = None,
) -> tuple[DataFrame, FittedScaler]:
    """Label and scaled feature columns, still as plain numbers, and the scaler used.

    The scaler is fitted on ``df`` (n-1) unless one is given, e.g. from the train part.
    Unneeded columns are pruned before anything is computed.
    """
    select_features(df, feats)
    slim = df.select(*dict.fromkeys([*keep, value_col, *feats]))
    labelled = filter_labelled(label_threshold(slim, value_col, threshold))
    if scaler is None:
        scaler = fit_scaler(slim, feats, ddof=1)
    return apply_fitted(labelled, scaler), scaler


def prepare(
    df: DataFrame,
    threshold: float = ACTIVE_BELOW,
    feats: Sequence[str] = tuple(DEFAULT_FEATURES),
    keep: Sequence[str] = ("id",),
    value_col: str = "standard_value",
    scaler: FittedScaler | None = None,
    handle_invalid: str = "error",
) -> DataFrame:
    """``keep..., features, label`` ready for :func:`tabstride.sources.tables.write_prepared`."""
    columns, _ = prepare_columns(df, threshold, feats, keep, value_col, scaler)
    vectors = assemble(columns, feats, "scaledFeatures", handle_invalid)
    return project_prepared(vectors, keep)
