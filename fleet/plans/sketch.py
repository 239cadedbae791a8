"""Quantiles of many columns and groups in one pass: mergeable sketches in a binary column.

A sketch is a sorted list of values with weights. Up to ``size`` values it is the data itself and its quantiles are exact.
Beyond, it is cut to ``size`` values that stand for equal shares of the weight, which moves no rank by more than half a
share. Tasks cut blocks of rows and join them like the digits of a binary counter, so that a value is cut about
log2(blocks) times; sketches of tasks are then joined ``FAN_IN`` at a time, in a stream per column. With 32 values a bin the sum of all cuts
stays below a quarter of a bin for a million rows a task and a thousand tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

BLOCK_ROWS = 32_768
HELD_BYTES = 64 << 20
FAN_IN = 32
LEAST_SIZE = 2_048

Sketch = tuple[np.ndarray, np.ndarray]


def cut(values: np.ndarray, weights: np.ndarray, size: int) -> Sketch:
    """At most ``size`` values, each for an equal share of the weight; equal picks are one value."""
    if len(values) <= size:
        return values, weights
    total = weights.sum()
    at = np.searchsorted(np.cumsum(weights), (np.arange(size) + 0.5) * (total / size), side="left")
    at, times = np.unique(np.minimum(at, len(values) - 1), return_counts=True)
    return values[at], times * (total / size)


def join(parts: list[Sketch], size: int) -> Sketch:
    values, weights = (np.concatenate(side) for side in zip(*parts))
    order = np.argsort(values, kind="stable")
    return cut(values[order], weights[order], size)


def quantiles(sketch: Sketch, probs: np.ndarray) -> np.ndarray:
    """Values at the shares ``probs``: interpolated where every row is there, the value of the rank otherwise."""
    values, weights = sketch
    if not len(values):
        return np.empty(0)
    if (weights == 1).all():
        at = probs * (len(values) - 1)
        low, high = values[np.floor(at).astype(np.int64)], values[np.ceil(at).astype(np.int64)]
        return low + (high - low) * (at - np.floor(at))
    at = np.searchsorted(np.cumsum(weights), probs * weights.sum(), side="left")
    return values[np.minimum(at, len(values) - 1)]


def to_bytes(sketch: Sketch) -> bytes:
    return sketch[0].tobytes() + sketch[1].tobytes()


def from_bytes(data: bytes) -> Sketch:
    both = np.frombuffer(data, np.float64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def key_places(keys: list[pa.Array], rows: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """The distinct keys of a batch, each with the places of its rows."""
    codes = np.zeros(rows, np.int64)
    for column in keys:
        coded = column.dictionary_encode()
        own = coded.indices.fill_null(len(coded.dictionary)).to_numpy().astype(np.int64)
        codes = np.unique(codes * (len(coded.dictionary) + 1) + own, return_inverse=True)[1]
    ends = np.cumsum(np.bincount(codes))[:-1]
    for at in np.split(np.argsort(codes, kind="stable"), ends):
        yield tuple(column[int(at[0])].as_py() for column in keys), at


class _Group:
    """Rows of one group: a buffer, and sketches of each column by level."""

    def __init__(self, width: int, size: int):
        self.width, self.size = width, size
        self.rows: list[np.ndarray] = []
        self.held = 0
        self.levels: list[list[Sketch | None]] = [[] for _ in range(width)]

    def add(self, rows: np.ndarray) -> None:
        self.rows.append(rows)
        self.held += len(rows)
        if self.held >= max(BLOCK_ROWS, 2 * self.size):
            self.fold()

    def fold(self) -> None:
        """Turn the buffer into sketches; two of one level become one of the next."""
        if not self.rows:
            return
        block = np.concatenate(self.rows)
        self.rows, self.held = [], 0
        for column, levels in zip(block.T, self.levels):
            values = np.sort(column[~np.isnan(column)])
            found = cut(values, np.ones(len(values)), self.size)
            level = 0
            while level < len(levels) and levels[level] is not None:
                found, levels[level] = join([levels[level], found], self.size), None
                level += 1
            levels += [None] * (level + 1 - len(levels))
            levels[level] = found

    def sketches(self) -> list[Sketch]:
        self.fold()
        none = (np.empty(0), np.empty(0))
        return [join([x for x in levels if x is not None] or [none], self.size) for levels in self.levels]


def column_quantiles(df: DataFrame, array: str, probs: list[float], by: list[str] | None = None, size: int | None = None) -> DataFrame:
    """The keys, ``feature`` (the position in ``array``) and ``quantiles``; null and NaN values do not count.

    The rows are read once and not shuffled. A group whose values are all missing has empty quantiles.
    """
    keys, size = list(by or []), size or max(LEAST_SIZE, 32 * (len(probs) + 1))
    source = df.select(*keys, F.col(array).alias("_x")).where("_x IS NOT NULL")
    named = [source.schema[k] for k in keys]
    kind = T.StructType([*named, T.StructField("feature", T.IntegerType()), T.StructField("sketch", T.BinaryType())])
    shares = np.array(probs)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, _Group] = {}
        held, types = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(k).type for k in keys]
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            for key, at in key_places([batch.column(k) for k in keys], batch.num_rows):
                groups.setdefault(key, _Group(x.shape[1], size)).add(x if len(at) == len(x) else x[at])
            held += x.nbytes
            if held > HELD_BYTES:
                for group in groups.values():
                    group.fold()
                held = 0
        for key, group in groups.items():
            found = group.sketches()
            columns = [pa.array([v] * len(found), t) for v, t in zip(key, types)]
            columns += [pa.array(range(len(found)), pa.int32()), pa.array([to_bytes(s) for s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=kind.names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, levels = None, [[]]
        for batch in batches:
            head = batch.slice(0, 1).select(kind.names[:-1]) if head is None else head
            for data in batch.column("sketch").to_pylist():
                levels[0].append(from_bytes(data))
                level = 0
                while len(levels[level]) == FAN_IN:  # a full level becomes one sketch of the next
                    if level + 1 == len(levels):
                        levels.append([])
                    levels[level + 1].append(join(levels[level], size))
                    levels[level] = []
                    level += 1
        found = join([s for level in levels for s in level], size)
        value = pa.array([quantiles(found, shares).tolist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*head.columns, value], names=[*kind.names[:-1], "quantiles"])

    final = T.StructType([*kind.fields[:-1], T.StructField("quantiles", T.ArrayType(T.DoubleType()))])
    return source.mapInArrow(sketch, kind).groupBy(*keys, "feature").applyInArrow(merge, final)
