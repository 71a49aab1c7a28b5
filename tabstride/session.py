"""Session settings, lineage cuts and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes up to which a table may be broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8_000_000


def build_session(
    app_name: str = "tabstride", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with adaptive execution on and a fixed time zone.

    Keyword names use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local session that names none.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tabstride-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for a table that is written and read back."""
    return f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder; later reads survive executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, for rows that are costly and read often.

    Unlike ``materialize`` it keeps columns apart and compressed, so a reader takes only those it
    needs.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _bytes(name: str, kind: T.DataType) -> Column:
    """About the bytes of a value: its length, or that of its text form for nested types."""
    column = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(column)))
    else:
        return F.lit(8).cast("bigint")
    return F.coalesce(size, F.lit(0)).cast("bigint")


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add a broadcast hint when ``df`` is measured to be small, else leave the join to Spark.

    Rows and bytes are counted.  Meant for stored tables, where that recomputes nothing large.
    """
    width = reduce(lambda a, b: a + b, [_bytes(f.name, f.dataType) for f in df.schema])
    seen = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(width).alias("size")).first()
    small = seen["n"] <= max_rows and (seen["size"] or 0) <= max_bytes
    return F.broadcast(df) if small else df
