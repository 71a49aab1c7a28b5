"""Batch scoring with a fitted scaler and net."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabstride.constants import NET_THRESHOLD
from tabstride.functions import named
from tabstride.operators.columns import (
    apply_threshold,
    id_columns,
    passthrough_ids,
    select_features,
)
from tabstride.operators.net import NetWeights, mlp_score
from tabstride.operators.scaling import FittedScaler, apply_fitted, impute


def score_batch(
    df: DataFrame,
    feats: Sequence[str],
    scaler: FittedScaler,
    weights: NetWeights,
    t: float = NET_THRESHOLD,
    id_col: str | None = None,
) -> DataFrame:
    """Check, impute, scale, score, decide; returns ids, ``prob_active``, ``pred_active``.

    The scaler must be fitted on exactly these features, in any order, and the net must take
    as many inputs.  Row-wise throughout, with one Arrow crossing for the net.  A constant feature is only
    centred, as in the fit of the net.
    """
    select_features(df, feats)
    if sorted(scaler.features) != sorted(feats):
        raise ValueError(f"Scaler is fitted on {list(scaler.features)}, not on {list(feats)}")
    width = weights.layers[0][0].shape[1]
    if width != len(feats):
        raise ValueError(f"Net takes {width} inputs, not {len(feats)}")
    place = [scaler.features.index(f) for f in feats]
    slim = df.select(*map(named, dict.fromkeys([*id_columns(df, id_col), *feats])))
    ids = id_columns(slim, id_col)
    # Ids keep their values even when an id column is a feature too.
    kept = slim.select(*ids, *[named(f).alias(f"_x{i}") for i, f in enumerate(feats)])
    inputs = [f"_x{i}" for i in range(len(feats))]
    renamed = FittedScaler(
        tuple(inputs), tuple(scaler.means[i] for i in place), tuple(scaler.stds[i] for i in place)
    )
    filled = impute(kept, inputs, renamed)
    scored = mlp_score(apply_fitted(filled, renamed, constant="one"), inputs, weights)
    return passthrough_ids(apply_threshold(scored, t=t), id_col)
