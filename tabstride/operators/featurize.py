"""Row-wise featurisation with a pluggable kernel."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NativeKernel = Callable[[Column], Column]
RowKernel = Callable[[str], Mapping[str, float] | None]
BatchKernel = Callable[[pa.Array], tuple[Mapping[str, np.ndarray], np.ndarray | None]]


def featurize(df: DataFrame, input_col: str, kernel: NativeKernel) -> DataFrame:
    """Append the fields of the kernel's struct; rows where it is null are dropped."""
    described = df.withColumn("_numbers", kernel(F.col(input_col)))
    return described.filter(F.col("_numbers").isNotNull()).select(*df.columns, "_numbers.*")


def python_kernel(function: RowKernel, names: Sequence[str]) -> NativeKernel:
    """Wrap a Python function of one string that returns named numbers, or None if invalid.

    The values travel in Arrow batches.  A null input gives null without a call.
    """
    names = list(names)

    def describe(text: str | None) -> list[float] | None:
        numbers = None if text is None else function(text)
        return None if numbers is None else [float(numbers[n]) for n in names]

    @F.pandas_udf("array<double>")
    def batches(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([describe(t) for t in batch], dtype=object)

    # Kept from being pushed into a filter, where a costly kernel would run a second time.
    once = batches.asNondeterministic()

    def named(values: Column) -> Column:
        fields = [values[i].alias(n) for i, n in enumerate(names)]
        return F.when(values.isNotNull(), F.struct(*fields))

    def kernel(c: Column) -> Column:
        # The lambda binds the result, so the function is called once for all fields.
        return F.transform(F.array(once(c)), named)[0]

    return kernel


def featurize_batches(
    df: DataFrame, input_col: str, function: BatchKernel, names: Sequence[str]
) -> DataFrame:
    """Append the numbers that ``function`` gives for a whole Arrow batch in one call.

    ``function`` takes the batch's input values, none of them null, and returns numpy columns by
    name and a mask of valid rows (None: all).  Null inputs and invalid rows are dropped; a null
    input reaches neither the function nor the Python worker.
    """
    names, place = list(names), df.columns.index(input_col)
    clash = sorted(set(names) & set(df.columns))
    if clash:
        raise ValueError(f"Columns are there already: {clash}")
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, valid = function(batch.column(place))
            columns = [pa.array(np.asarray(numbers[n], dtype=float)) for n in names]
            out = pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *names]
            )
            yield out if valid is None else out.filter(pa.array(np.asarray(valid, dtype=bool)))

    return df.filter(F.col(input_col).isNotNull()).mapInArrow(describe, schema)
