"""Groups of rows inside a task, for rows that arrive sorted by a key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def by_key(
    batches: Iterator[pa.RecordBatch], key: str, least: int = 2
) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``key``, one table each; holds one group.

    Groups of fewer than ``least`` rows are passed over.
    """
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(keys)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            if held and keys[low] != held_key:
                if sum(b.num_rows for b in held) >= least:
                    yield pa.Table.from_batches(held)
                held = []
            held_key = keys[low]
            if high - low >= least or low == 0 or high == len(keys):
                held.append(batch.slice(low, high - low))
    if held and sum(b.num_rows for b in held) >= least:
        yield pa.Table.from_batches(held)


def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values back to back, and each row's bounds in them."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    sizes = np.diff(array.offsets.to_numpy())
    return array.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])


def local_components(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the lowest row reachable from each row."""
    label = np.full(len(linked), -1)
    for seed in range(len(linked)):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        front = linked[seed] & (label < 0)
        while front.any():
            label[front] = seed
            front = linked[front].any(axis=0) & (label < 0)
    return label
