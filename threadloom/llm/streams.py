"""Sorted Arrow batches regrouped so that no group is cut by a batch border."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def row_changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which a row differs from the one before in any of ``keys`` (nulls are equal)."""
    n = table.num_rows
    if n < 2:
        return np.zeros(0, np.int64)
    changed = np.zeros(n - 1, bool)
    for key in keys:
        column = table.column(key).combine_chunks()
        null = column.is_null().to_numpy(zero_copy_only=False)
        same = pc.fill_null(pc.equal(column[1:], column[:-1]), False).to_numpy(zero_copy_only=False)
        changed |= ~(same | (null[1:] & null[:-1]))
    return np.flatnonzero(changed) + 1


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds) of one or more complete groups of an input that is sorted by ``keys``.

    Only the group still open at the end of a batch is held back, so memory is bounded by a batch
    and the largest group.
    """
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        probe = pa.concat_tables([held[-1].slice(held[-1].num_rows - 1), table]) if held else table
        changes = row_changes(probe, keys) - (1 if held else 0)
        if len(changes):
            cut = int(changes[-1])
            ready = pa.concat_tables([*held, table.slice(0, cut)]).combine_chunks()
            yield ready, np.concatenate([[0], row_changes(ready, keys), [ready.num_rows]])
            held = [table.slice(cut)]
        else:
            held.append(table)
    if held:
        ready = pa.concat_tables(held).combine_chunks()
        yield ready, np.concatenate([[0], row_changes(ready, keys), [ready.num_rows]])
