"""Persistence of fitted things and of run records, all as Parquet or Spark ML folders."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstride.constants import DEFAULT_FEATURES
from tabstride.operators.net import NetWeights
from tabstride.operators.scaling import FittedScaler


def save_features(spark: SparkSession, feats: Sequence[str], path: str) -> None:
    table = spark.createDataFrame([(list(feats),)], "features array<string>")
    table.coalesce(1).write.mode("overwrite").parquet(path)


def resolve_features(spark: SparkSession, artefact=None) -> list[str]:
    """Feature names from a list, a dict with key ``features``, or a saved table.

    Nothing at the path gives the default features; anything else is an error.
    """
    if artefact is None:
        return list(DEFAULT_FEATURES)
    if isinstance(artefact, (list, tuple)):
        return list(artefact)
    if isinstance(artefact, Mapping) and "features" in artefact:
        return list(artefact["features"])
    if not isinstance(artefact, str):
        raise ValueError("Invalid features artifact.")
    try:
        table = spark.read.parquet(artefact)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return list(DEFAULT_FEATURES)
        raise
    if dict(table.dtypes).get("features") != "array<string>":
        raise ValueError("Invalid features artifact.")
    return list(table.first()["features"])


def save_scaler(spark: SparkSession, scaler: FittedScaler, path: str) -> None:
    scaler.to_df(spark).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> FittedScaler:
    return FittedScaler.from_df(spark.read.parquet(path))


def save_net(spark: SparkSession, weights: NetWeights, path: str) -> None:
    weights.to_df(spark).write.mode("overwrite").parquet(path)


def load_net(spark: SparkSession, path: str) -> NetWeights:
    return NetWeights.from_df(spark.read.parquet(path))


def save_forest(model: RandomForestClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_forest(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


_RUN_COLUMNS = "run_id string, kind string, key string, value string"


def _commit(rows: DataFrame, path: str, part: str, size: int) -> None:
    """Write the ``size`` rows of one call, each with the call's id, time and size.

    Each call has its own folder, as writers to one folder share their temporary files.
    """
    call = uuid.uuid4().hex
    rows.select(
        "run_id", "kind", "key", "value",
        F.lit(part).alias("part"), F.lit(call).alias("call"),
        F.lit(time.time_ns()).alias("called_at"), F.lit(size).cast("bigint").alias("call_rows"),
    ).coalesce(1).write.parquet(f"{path}/{call}")


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
) -> None:
    """Log the params and metrics of a run as rows ``run_id, kind, key, value``.

    Calls only add, so runs can log side by side.  A second call for the same run, as by a
    retried job, stands in place of the first; a call that broke off counts for nothing.  A call
    without params and metrics logs nothing.
    """
    rows = [(run_id, "param", k, str(v)) for k, v in (params or {}).items()]
    rows += [(run_id, "metric", k, repr(float(v))) for k, v in (metrics or {}).items()]
    if rows:
        _commit(spark.createDataFrame(rows, _RUN_COLUMNS), path, "run", len(rows))


def log_metrics_table(df: DataFrame, path: str, run_id: str, digits: int | None = None) -> None:
    """Log a one-row metrics table of a run without bringing it to the driver.

    The table is committed as a whole, apart from what ``log_run`` logs for the run, and by the
    same rules.
    """
    value = lambda c: F.col(c) if digits is None else F.round(c, digits)
    cells = F.array(*[F.struct(F.lit(c).alias("key"), value(c).cast("string").alias("value"))
                      for c in df.columns])
    rows = df.select(
        F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"), F.inline(cells)
    )
    _commit(rows, path, "table", len(df.columns))


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, kind, key, value`` of the last whole call per run and part."""
    calls = spark.read.option("recursiveFileLookup", True).parquet(path)
    whole = (
        calls.groupBy("run_id", "part", "call", "called_at", "call_rows")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n = call_rows")
        .groupBy("run_id", "part")
        .agg(F.max(F.struct("called_at", "call")).alias("last"))
    )
    chosen = whole.select(F.col("last.call").alias("call"))
    return calls.join(chosen, "call", "left_semi").select("run_id", "kind", "key", "value")
