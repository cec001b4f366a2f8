"""Parts of an Arrow batch, so that what a Python function holds at once does not grow with the batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# List elements of the rows that are taken at once. Tokens as Python objects are about a hundred bytes each.
ELEMENTS_AT_ONCE = 1 << 17


def parts(*lists: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """The same rows of list arrays, in order, as many as hold ``ELEMENTS_AT_ONCE`` elements together; at least one."""
    sizes = np.ones(len(lists[0]), np.int64)  # a row without elements counts as well
    for one in lists:
        sizes += pc.fill_null(pc.list_value_length(one), 0).to_numpy()
    ends = np.cumsum(sizes)
    start = done = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, done + ELEMENTS_AT_ONCE, "right")))
        yield tuple(one.slice(start, stop - start) for one in lists)
        start, done = stop, int(ends[stop - 1])
