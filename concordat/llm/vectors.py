"""What the block-wise operators share: streamed groups, usable vectors, fast Hadamard rotations, exact scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors that are not null, empty or zero and hold finite numbers only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis, whose length is a power of two, scaled to keep lengths."""
    n = x.shape[-1]
    h = 1
    while h < n:
        x = x.reshape(*x.shape[:-1], -1, 2, h) if x.shape[-1] == n else x
        top, bottom = x[..., 0, :], x[..., 1, :]
        x = np.stack([top + bottom, top - bottom], axis=-2).reshape(*x.shape[:-3], n)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """A pseudo-random rotation: three rounds of random signs and a Hadamard transform; pads to a power of two."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    if size > x.shape[1]:
        x = np.hstack([x, np.zeros((len(x), size - x.shape[1]))])
    rng = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], size))
    return x


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1] if a.shape[1] else np.zeros(len(a))


def group_changes(table: pa.Table, keys: int) -> np.ndarray:
    """For each row but the first, whether it begins a new group."""
    new = np.zeros(max(0, len(table) - 1), bool)
    for k in range(keys):
        v = table.column(k).to_numpy()
        new |= v[1:] != v[:-1]
    return new


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables that end at the end of a group, from sorted batches. A group is bounded, so is what is held; each batch is put together once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = np.flatnonzero(group_changes(pa.Table.from_batches([batch]), keys))
        last = int(cuts[-1]) + 1 if len(cuts) else 0
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in range(keys)):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
