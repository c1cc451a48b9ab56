"""Arrow batches in tasks: slices of bounded size, and columns with nulls filled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20


def texts_of(column: pa.Array) -> pa.Array:
    """The column as strings, null as the empty text."""
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    return column.fill_null("") if column.null_count else column


def offsets_of(texts: pa.Array) -> np.ndarray:
    """Byte offsets of the texts in their buffer, one more than there are texts."""
    if not len(texts):
        return np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)
    return offsets[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one behind another, and the offsets of the texts in them."""
    offsets = offsets_of(texts)
    data = texts.buffers()[2] if len(texts) else None
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts hold about ``limit`` bytes; a longer text has a slice of its own."""
    rows = len(batch)
    if not rows:
        return
    offsets = offsets_of(texts_of(batch.column(text)))
    start = 0
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(rows, max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: the first ``counts[0]`` values belong to row 0, and so on."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


__all__ = ["SLICE_BYTES", "bytes_of", "has_letter", "lists", "offsets_of", "slices", "texts_of"]
