"""Documents as Arrow batches: pass-through of all columns, and texts as flat byte arrays.

Shared by the operators of this package. A null text counts as the empty text everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that one round of array work holds at once; a longer single text is a round of its own.
SLICE_BYTES = 1 << 20


def free_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores added until no column of `df` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and the n + 1 offsets of the texts in them."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of texts that together have at most `limit` bytes, or hold one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def map_texts(
    docs: DataFrame, text: str, name: str, result: T.StructType, fn: Callable[[pa.Array], list[pa.Array]]
) -> DataFrame:
    """`docs` with a struct column `name` that `fn` computes from the column `text`, row by row.

    All other columns pass unchanged. `fn` gets a string array and returns an array per field of
    `result`; it is given at most SLICE_BYTES of text at a time, or one longer text.
    """
    at = docs.columns.index(text)
    arrow = [_arrow(f.dataType) for f in result]
    names = [f.name for f in result]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at).cast(pa.large_string()).fill_null("")
            _, offsets = flat(column)
            for i, j in slices(offsets, 4 * SLICE_BYTES):
                out = [a.cast(t) for a, t in zip(fn(column.slice(i, j - i)), arrow)]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.StructArray.from_arrays(out, names)], [*part.schema.names, name]
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, result)]))


def _arrow(kind: T.DataType) -> pa.DataType:
    simple = {
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
        T.DoubleType: pa.float64(),
        T.BooleanType: pa.bool_(),
        T.StringType: pa.string(),
        T.BinaryType: pa.binary(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return simple[type(kind)]
