"""Shared small helpers: bounded slices of Arrow batches, text folding, hash folds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold about ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes, null as empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts, null as empty."""
    return [value or "" for value in batch.column(column).to_pylist()]


def fold_case(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty. Pure ASCII text takes the quick built-in."""
    filled = F.coalesce(text, F.lit(""))
    return F.when(F.length(filled) == F.octet_length(filled), F.lower(filled)).otherwise(
        F.translate(filled, UPPER, UPPER.lower()))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
