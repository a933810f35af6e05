"""Arrow batches of texts, taken in parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and bytes of a part, which bound what a task holds as Python objects; one longer text is a part of its own.
PART_ROWS, PART_BYTES = 512, 1 << 20


def parts_of(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of a string column in order, at least one."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        most = (ends[at - 1] if at else 0) + PART_BYTES
        stop = min(max(int(np.searchsorted(ends, most, "right")), at + 1), at + PART_ROWS)
        yield texts.slice(at, stop - at)
        at = stop
    if not len(texts):
        yield texts
