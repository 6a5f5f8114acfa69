"""Texts laid end to end in NumPy, and cut between neighbouring characters that nothing joins.

A character at the beginning of a text is kept apart from the others: its code point is raised by ``HEAD``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .cutting import CODE_POINTS, CUT_BYTES, _places, bounded

HEAD = CODE_POINTS
CODES = 2 * CODE_POINTS
NONE = -1  # what stands before the first character
DENSE = 1 << 22  # entries of a table of pairs


class Joints:
    """Which pairs of codes are joined."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.sides = [np.unique(side) for side in (left, right)]
        self.width = len(self.sides[1]) + 1
        self.places = []
        for side in self.sides:
            place = np.zeros(int(side.max(initial=0)) + 2, np.int32)
            place[side] = np.arange(1, len(side) + 1)
            self.places.append(place)
        keys = np.unique(self._keys(left, right))
        self.table = None
        if (len(self.sides[0]) + 1) * self.width <= DENSE:
            self.table = np.zeros((len(self.sides[0]) + 1) * self.width, bool)
            self.table[keys] = True
        self.keys = keys

    def _keys(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        left, right = (place[np.minimum(codes, len(place) - 1)] for place, codes in zip(self.places, (left, right)))
        return left.astype(np.int64) * self.width + right

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._keys(left, right)
        if self.table is not None:
            return self.table[keys]
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


def laid(texts: pa.Array) -> np.ndarray:
    """The codes of the texts that are not null or empty."""
    texts = texts.drop_null()
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    raw = b"".join(texts.cast(pa.binary()).to_pylist())
    codes = np.frombuffer(raw.decode().encode("utf-32-le"), "<i4").copy()
    heads = (np.cumsum(sizes, dtype=np.int64) - sizes)[sizes > 0]
    codes[heads if len(codes) == len(raw) else np.searchsorted(_places(codes), heads)] += HEAD
    return codes


def laid_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The codes of the first column, a bounded number at a time."""
    for batch in batches:
        for part in bounded(batch.column(0), CUT_BYTES):
            codes = laid(part)
            if len(codes):
                yield codes


def strings(codes: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The strings of the code points that begin at ``starts``; the first one is 0."""
    offsets = _places(codes)[np.append(starts, len(codes))]
    raw = codes.astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


class PairCounter:
    """Adds up neighbouring codes; the first one of a text is counted with ``NONE`` before it."""

    def __init__(self):
        self.place = np.zeros(CODES, np.int32)
        self.keys, self.n = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, codes: np.ndarray) -> None:
        seen = np.zeros(CODES, bool)
        seen[codes] = True
        used = np.flatnonzero(seen)
        self.place[used] = np.arange(len(used))
        at = self.place[codes].astype(np.int64)
        keys = at[:-1] * len(used) + at[1:]
        if len(used) ** 2 <= max(DENSE, 4 * len(codes)):
            counts = np.bincount(keys, minlength=len(used) ** 2)
            keys = np.flatnonzero(counts)
            counts = counts[keys]
        else:
            keys, counts = np.unique(keys, return_counts=True)
        left, right = used[keys // len(used)], used[keys % len(used)]
        inside = right < HEAD
        heads, first = np.unique(codes[codes >= HEAD], return_counts=True)
        self._gather(np.concatenate([self.keys, (left[inside] + 1) << 32 | right[inside], heads - HEAD]),
                     np.concatenate([self.n, counts[inside], first]))

    def _gather(self, keys: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.n = keys[first], np.add.reduceat(n[order], first)

    def found(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array((self.keys >> 32).astype(np.int32) - 1, pa.int32()),
             pa.array((self.keys & (1 << 32) - 1).astype(np.int32), pa.int32()), pa.array(self.n, pa.int64())],
            ["left", "right", "n"])
