"""CSV and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts read as missing: fixed values.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_TIMESTAMP_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    null_tokens: Sequence[str] = tuple(NULL_TOKENS),
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header.  Without a schema one extra pass finds the column types.

    Columns are matched to the schema by the name in the header; all files must have the same
    header.  Files are split between tasks, so a quoted line break is an error unless
    ``multi_line`` is set, which reads every file in one piece.
    """
    names = spark.read.csv(path, header=True, escape='"', multiLine=multi_line).columns
    wanted = list(_declared(schema)) if schema is not None else names
    unknown = [c for c in wanted if c not in names]
    if unknown:
        raise ValueError(f"Columns not in the header: {unknown}")
    # With pruning a broken record would go unnoticed in the columns that are not read.
    texts = spark.read.option("columnPruning", multi_line).csv(
        path,
        header=True,
        escape='"',
        mode="FAILFAST",
        multiLine=multi_line,
        schema=T.StructType([T.StructField(c, T.StringType()) for c in names]),
        enforceSchema=False,
    )
    tokens = list(null_tokens)
    present = texts.select(
        *[F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c) for c in wanted]
    )
    types = _declared(schema) if schema is not None else _observed(present)
    return present.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in present.columns])


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _declared(schema: T.StructType | str) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in _struct(schema)}


def _observed(texts: DataFrame) -> dict[str, str]:
    """The narrowest of bigint, double, boolean that all present texts fit, else string."""
    counts = texts.agg(
        *[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(texts.columns)],
        *[
            F.count(fit).alias(f"{kind}{i}")
            for i, c in enumerate(texts.columns)
            for kind, fit in _fits(F.col(f"`{c}`")).items()
        ],
    ).first()
    types = {}
    for i, c in enumerate(texts.columns):
        n = counts[f"n{i}"]
        fitting = [k for k in ("bigint", "double", "boolean") if counts[f"{k}{i}"] == n]
        types[c] = "double" if n == 0 else next(iter(fitting), "string")
    return types


def _fits(text: Column) -> dict[str, Column]:
    """Per type a column that is present where the text has that type.

    Whole numbers and truth values are matched before the cast, as a failing cast is slow.
    """
    whole = F.when(text.rlike(r"^[+-]?[0-9]{1,19}$"), text.try_cast("bigint"))
    truth = F.when(F.lower(text).isin("true", "false"), True)
    return {"bigint": whole, "double": text.try_cast("double"), "boolean": truth}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every part file; missing folders are made."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampFormat", _TIMESTAMP)
        .option("timestampNTZFormat", _TIMESTAMP_NTZ)
        .csv(path)
    )


def scan_prepared(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_prepared(df: DataFrame, path: str) -> int:
    """Overwrite a Parquet dataset; the row count is read from the new files' footers."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()
