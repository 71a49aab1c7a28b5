"""Paged JSON ingest."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabstride.constants import DEFAULT_STANDARD_TYPE, DEFAULT_TARGET
from tabstride.session import materialize

RECORDS_FIELD = "activities"


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row ``offset, body`` per page file; the offset is the last number in its name."""
    name = F.regexp_extract(F.input_file_name(), r"(\d+)[^/\d]*$", 1)
    return spark.read.text(path, wholetext=True).select(
        name.cast("bigint").alias("offset"), F.col("value").alias("body")
    )


def record_schema(pages: DataFrame, records_field: str = RECORDS_FIELD) -> T.StructType | None:
    """Type of one record: the union of all keys over all pages; None if no page has a record."""
    kind = pages.agg(
        F.schema_of_variant_agg(F.parse_json("body")).alias("kind")
    ).first()["kind"]
    ddl = re.sub(r"DECIMAL\(\d+,\s?\d+\)", "DOUBLE", (kind or "VOID").replace("OBJECT<", "STRUCT<"))
    whole = T.DataType.fromDDL(re.sub(r"\bVOID\b", "STRING", ddl))
    if not isinstance(whole, T.StructType) or records_field not in whole.names:
        return None
    listed = whole[records_field].dataType
    record = listed.elementType if isinstance(listed, T.ArrayType) else None
    return record if isinstance(record, T.StructType) else None


def ingest_pages(
    pages: DataFrame,
    schema: T.DataType | str | None = None,
    records_field: str = RECORDS_FIELD,
) -> DataFrame:
    """Records of all pages before the first page that has none.

    A page ends the ingest if its list is empty or its key is absent, as a reader that
    fetches page after page would.  A body that is missing or no valid JSON, or a value that
    does not have its declared type, is an error.  Without a schema and without any record
    the result is an empty table without columns.  Each body is parsed once; the parsed
    pages are stored.
    """
    if schema is None:
        schema = record_schema(pages, records_field)
        if schema is None:
            return pages.sparkSession.createDataFrame([], T.StructType([]))
    record = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    shape = T.StructType([T.StructField(records_field, T.ArrayType(record))])
    # An empty body is read as null even in this mode.
    page = F.from_json("body", shape, {"mode": "FAILFAST"})
    wrong = F.raise_error(F.concat(F.lit("no JSON on page "), F.col("offset").cast("string")))
    body = F.when(page.isNotNull(), page).otherwise(wrong.cast(shape))
    parsed = materialize(pages.select(
        "offset", F.coalesce(body[records_field], F.array().cast(shape[0].dataType)).alias("records")
    ))
    stop = parsed.filter(F.size("records") == 0).agg(F.min("offset").alias("stop"))
    return (
        parsed.crossJoin(F.broadcast(stop))
        .filter(F.col("stop").isNull() | (F.col("offset") < F.col("stop")))
        .select(F.explode("records").alias("record"))
        .select("record.*")
    )


def filter_activities(
    df: DataFrame,
    target_id: str | int = DEFAULT_TARGET,
    standard_type: str = DEFAULT_STANDARD_TYPE,
    target_col: str = "target_chembl_id",
    type_col: str = "standard_type",
) -> DataFrame:
    """Activities of one target and one measurement type."""
    return df.filter((F.col(target_col) == target_id) & (F.col(type_col) == standard_type))


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Bag union with columns matched by name; absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)
