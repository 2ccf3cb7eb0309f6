"""Reading sorted partitions group by group."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal integer ``keys`` in a stream that is sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in keys], 1)
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(k[s].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets (from 0) of a list column without nulls."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks)
    offsets = a.offsets.to_numpy()
    return a.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def forest(n: int, left: Iterable[int], right: Iterable[int]) -> list[int]:
    """Union-find over n items: the least item of each one's set."""
    up = list(range(n))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in zip(left, right, strict=True):
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]
