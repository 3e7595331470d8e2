"""Helpers shared by the corpus operators: worker imports, scratch tables, bounded Arrow slices."""

from __future__ import annotations

import ctypes

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from ..session import _file_system, drop_scratch, saved, workers_import_package  # noqa: F401  (for every operator)

#: Text bytes that a Python task takes from Arrow at once.
SLICE_BYTES = 12 << 20


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop = _file_system(spark, path)
    fs.delete(hadoop, True)


def give_back_memory() -> None:
    """Return freed memory to the system: Python workers live on from stage to stage, and allocators keep what they had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library alone has it
    if trim:
        trim(0)


def text_slices(batches, column: str = "text", most: int = SLICE_BYTES):
    """Yield slices of record batches whose ``column`` holds at most ``most`` bytes, one row at least."""
    import numpy as np

    give_back_memory()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
    give_back_memory()


def plain_strings(column: pa.Array) -> pa.Array:
    """A string array without nulls (null: empty) and without an offset."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")
