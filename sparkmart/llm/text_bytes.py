"""Arrow text columns as numpy byte arrays, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; one longer text makes a block of its own.
BLOCK_BYTES = 1 << 20
#: Texts handled at a time.
BLOCK_ROWS = 4096


class Block(NamedTuple):
    """Consecutive rows ``first..last`` of a batch: their bytes back to back."""

    first: int
    last: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than rows, from 0

    @property
    def rows(self) -> int:
        return self.last - self.first

    def owner(self) -> np.ndarray:
        """The row of each byte, counted from the block's first."""
        return np.repeat(np.arange(self.rows), np.diff(self.offsets))


def blocks(
    column: pa.Array, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS
) -> Iterator[Block]:
    """Cut a string column into blocks; a null text is an empty one."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    rows = len(column)
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(what, np.uint8) if what is not None else np.empty(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1
        last = min(max(last, first + 1), first + block_rows, rows)
        low, high = int(offsets[first]), int(offsets[last])
        yield Block(first, last, data[low:high], offsets[first : last + 1] - low)
        first = last
