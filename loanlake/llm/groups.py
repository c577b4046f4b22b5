"""Whole groups of rows that arrive sorted by key."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """The rows that start a group."""
    starts = np.zeros(table.num_rows, dtype=bool)
    if len(starts):
        starts[0] = True
    for key in keys:
        column = table.column(key).combine_chunks()
        differs = pc.fill_null(pc.not_equal(column[1:], column[:-1]), True)
        starts[1:] |= differs.to_numpy(zero_copy_only=False)
    return np.flatnonzero(starts)


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], at_least: int = 20_000
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, with the first row of each group and the number of rows as last entry.

    Rows must be sorted by ``keys``, which hold no NULL. A table has ``at_least`` so many rows, unless it is the
    last, and at most one group and one batch more.
    """
    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        rows += batch.num_rows
        if rows < at_least:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        starts = _changes(table, keys)
        if len(starts) < 2:
            continue
        yield table.slice(0, starts[-1]), starts
        rest = table.slice(starts[-1])
        waiting, rows = rest.to_batches(), rest.num_rows
    if waiting:
        table = pa.Table.from_batches(waiting).combine_chunks()
        yield table, np.append(_changes(table, keys), table.num_rows)
