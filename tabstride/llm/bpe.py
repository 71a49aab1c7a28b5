"""BPE encoding and decoding of text columns.

Merging is ``word_bpe.BpeFile.encode_word``: a priority queue of merge ranks over a doubly
linked symbol list that skips stale entries.  Decoding concatenates vocabulary strings.
Texts are handled in slices of Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstride.llm.hashing import text_slices
from tabstride.llm.word_bpe import SLICE_BYTES, own_encoder


def encode(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """Per row ``id, n_tokens long, ids binary`` and, on request, ``decoded string``.

    ``ids`` holds little-endian unsigned 32-bit numbers.  A null text is an empty one: no ids.
    Other columns are not read; repeated rows and null ids stay as they are.
    """
    kind = dict(df.select(id_col).dtypes)[id_col]
    schema = f"`{id_col}` {kind}, n_tokens long, ids binary" + ", decoded string" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = own_encoder(path)
        for part, _, _ in text_slices(batches, 1, SLICE_BYTES):
            ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            columns = [
                part.column(0),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
            ]
            if decoded:
                columns.append(pa.array([file.decode(x.tolist()) for x in ids], pa.string()))
            names = [id_col, "n_tokens", "ids", "decoded"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.select(id_col, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row ``id, decoded string`` from ids as ``encode`` writes them; null ids give ""."""
    import numpy as np

    kind = dict(df.select(id_col).dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, file = own_encoder(path)
        for batch in batches:
            texts = [
                file.decode(np.frombuffer(x or b"", "<u4").tolist())
                for x in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], [id_col, "decoded"]
            )

    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded string")
