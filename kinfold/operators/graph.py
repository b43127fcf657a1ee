"""Graphs inside one task: order-keeping node numbers and spanning forests of edge lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

#: Edges gathered before they are cut to a forest.
AT_ONCE = 500_000


def numbered(kind: T.DataType) -> bool:
    """Whether ``codes`` knows the order of the type."""
    if isinstance(kind, T.StructType):
        return all(numbered(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.StringType, T.IntegralType, T.DoubleType, T.DateType, T.BooleanType))


def codes(values: pa.Array) -> np.ndarray:
    """Equal numbers for equal values, in the order that Spark has them in: nulls first, structs field by field."""
    if pa.types.is_struct(values.type):
        out = np.zeros(len(values), np.int64)
        for part in (codes(x) for x in values.flatten()):
            out = np.unique(out * (int(part.max(initial=0)) + 1) + part, return_inverse=True)[1]
        return out
    found = values.dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(found.dictionary, null_placement="at_start").to_numpy(zero_copy_only=False)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[found.indices.to_numpy(zero_copy_only=False)]


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that keep ``n`` nodes connected as all edges do, without circles; and the smallest node of each node's component."""
    label, kept, left = np.arange(n), [np.zeros(0, np.int64)], np.arange(len(a))
    while True:
        x, y = label[a[left]], label[b[left]]
        cross = x != y
        left, x, y = left[cross], x[cross], y[cross]
        if not len(left):
            return np.concatenate(kept), label
        # Every root with a smaller neighbour goes below one of these.
        chosen = np.full(n, -1)
        chosen[np.maximum(x, y)] = np.arange(len(left))
        roots = np.flatnonzero(chosen >= 0)
        kept.append(left[chosen[roots]])
        label[roots] = np.minimum(x, y)[chosen[roots]]
        while not np.array_equal(label, further := label[label]):
            label = further


def _ends(edges: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All ends, their first places by number, and the numbers of both sides."""
    nodes = pa.concat_arrays([x for side in (0, 1) for x in edges.column(side).chunks])
    found, place, number = np.unique(codes(nodes), return_index=True, return_inverse=True)
    return nodes, place, *np.split(number, 2)


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(hi, lo)`` of a task, fewer of them with the same components."""
    kept, rows, cut = [], 0, 0
    for batch in batches:
        kept.append(batch)
        rows += batch.num_rows
        if rows >= 2 * cut + AT_ONCE:
            table = _cut(kept)
            kept, rows, cut = table.to_batches(), table.num_rows, table.num_rows
            if cut >= AT_ONCE:
                yield from kept
                kept, rows, cut = [], 0, 0
    if rows:
        yield from _cut(kept).to_batches()


def _cut(batches: list[pa.RecordBatch]) -> pa.Table:
    edges = pa.Table.from_batches(batches)
    _, place, a, b = _ends(edges)
    return edges.take(pa.array(np.sort(spanning(a, b, len(place))[0])))


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges in one task: ``(hi, lo)``, every node but the smallest of its component with that one."""
    batches = [batch for batch in batches if batch.num_rows]
    if not batches:
        return
    nodes, place, a, b = _ends(pa.Table.from_batches(batches))
    label = spanning(a, b, len(place))[1]
    above = np.flatnonzero(label != np.arange(len(label)))
    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(place[above])), nodes.take(pa.array(place[label[above]]))], ["hi", "lo"])
