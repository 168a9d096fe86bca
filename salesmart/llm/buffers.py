"""The bytes of a column of texts as one array, without a Python object per text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def texts_in(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column of texts, nulls as empty texts."""
    return pc.fill_null(batch.column(name).cast(pa.large_string()), "")


def joined(column: pa.Array, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, ``lead`` zero bytes before each, and where each text's bytes begin
    in them (one more entry for the end; the zeros before a text belong to none)."""
    column = column.cast(pa.large_string())
    n = len(column)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
    size = np.diff(at)
    out = np.zeros(len(data) + lead * n, dtype=np.uint8)
    begin = at[:-1] - at[0] + lead * np.arange(1, n + 1)
    out[np.arange(len(data)) + np.repeat(lead * np.arange(1, n + 1), size)] = data
    return out, np.r_[begin, len(out)]


def pieces(column: pa.Array, limit: int):
    """(first row, slice) of consecutive rows with about ``limit`` bytes; a longer text is alone."""
    size = np.diff(np.frombuffer(column.cast(pa.large_string()).buffers()[1], np.int64)
                   [column.offset:column.offset + len(column) + 1])
    first, total = 0, 0
    for i, s in enumerate(size.tolist()):
        if i > first and total + s > limit:
            yield first, column.slice(first, i - first)
            first, total = i, 0
        total += s
    if len(column) > first:
        yield first, column.slice(first)
