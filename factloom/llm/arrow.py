"""Small helpers for Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The batch's rows, a few at a time so that only their Python objects are alive."""
    for i in range(0, batch.num_rows, 128):
        part = batch.slice(i, 128)
        yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def freed() -> None:
    """Give memory that Arrow and the C library hold without need back to the system: Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def slices_of(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows; memory that is no longer used goes back at the end."""
    try:
        for b in batches:
            for i in range(0, b.num_rows, rows):
                yield b.slice(i, rows)
    finally:
        freed()
