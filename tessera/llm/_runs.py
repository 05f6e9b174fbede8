"""Whole groups of sorted Arrow batches, for code that works on many small
groups at once (one Python call per chunk instead of one per group)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def heads(batch: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Rows whose keys differ from those of the row before (the first row is one)."""
    n = batch.num_rows
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for k in keys:
        c = batch.column(k)
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        if n > 1:
            new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int, size: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(chunk, first row of each of its groups) of batches sorted by ``keys``
    (without nulls). A chunk holds whole groups, and about ``rows`` rows or
    ``size`` bytes; memory follows these bounds or the largest group."""
    held: list[pa.RecordBatch] = []
    n = held_bytes = 0
    for batch in batches:
        for part in _parts(batch, rows, size):
            held.append(part)
            n += part.num_rows
            held_bytes += part.nbytes
            if n < rows and held_bytes < size:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = heads(table, keys)
            cut = int(starts[-1])
            if cut:
                yield table.slice(0, cut), starts[:-1]
            rest = table.slice(cut)
            held = rest.to_batches()
            n, held_bytes = rest.num_rows, rest.nbytes
    if n:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, heads(table, keys)


def _parts(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    step = batch.num_rows if batch.nbytes <= size else max(1, int(batch.num_rows * size / batch.nbytes))
    step = max(1, min(step, rows))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)
