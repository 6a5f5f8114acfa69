"""Lists of whole numbers as short binary values, for tables and shuffles that are written on the way."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUES_AT_A_TIME = 1 << 18
SIGNED, HOLED, SPARSE = 8, 16, 32  # marks beside the number of bytes of a value, 1 to 4
LOOKED_AT = 4096  # values that tell which one is common


def _runs(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of rows with at most ``VALUES_AT_A_TIME`` values each, and at least one row."""
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + VALUES_AT_A_TIME, "right")))
        yield slice(start, stop)
        start = stop


def pack(lists: pa.ListArray) -> pa.Array:
    """One binary value for each list: a byte that tells its layout, then the first bytes of all values, then the second ones, and so on.

    Only as many bytes are kept as the values beside it need; with negative ones the sign goes to the last bit. Where one value is
    common, its places are kept as bits after the number of values and that value, and the others follow as above.
    """
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [_packed(lists.slice(run.start, run.stop - run.start), sizes[run]) for run in _runs(sizes)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def _packed(lists: pa.ListArray, sizes: np.ndarray) -> pa.Array:
    flat = lists.flatten()
    values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(np.int32)
    sign = SIGNED if len(values) and values.min() < 0 else 0
    bits = (values << 1 ^ values >> 31 if sign else values).view(np.uint32)
    width = max(1, (int(bits.max(initial=0)).bit_length() + 7) // 8)
    total, row = sizes, np.repeat(np.arange(len(sizes)), sizes)
    seen, counts = np.unique(bits[:LOOKED_AT], return_counts=True)
    common = seen[counts.argmax()] if len(seen) else np.uint32(0)
    rare = bits != common
    sparse = not flat.null_count and len(bits) / 8 + 8 * len(sizes) + width * rare.sum() < width * len(bits)
    head = np.ones(len(sizes), np.int64)
    if sparse:
        eighths = (sizes + 7) // 8
        padded = np.zeros(8 * int(eighths.sum()), bool)
        padded[np.repeat(8 * (np.cumsum(eighths) - eighths) - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(bits))] = rare
        bits, row, head = bits[rare], row[rare], 9 + eighths
        sizes = np.bincount(row, minlength=len(sizes))
    planes = list(bits.astype("<u4").view(np.uint8).reshape(-1, 4).T[:width])
    if flat.null_count:
        planes.append(flat.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8))
    ends = np.cumsum(head + sizes * len(planes))
    starts = np.concatenate([[0], ends[:-1]])
    data = np.empty(int(ends[-1]), np.uint8)
    data[starts] = width | sign | (HOLED if flat.null_count else 0) | (SPARSE if sparse else 0)
    if sparse:
        fixed = np.stack([total.astype("<u4"), np.full(len(total), common, "<u4")], axis=1).view(np.uint8)
        data[starts[:, None] + np.arange(1, 9)] = fixed
        data[np.repeat(starts + 9 - (np.cumsum(eighths) - eighths), eighths) + np.arange(eighths.sum())] = np.packbits(padded)
    at = np.repeat(starts + head - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(bits))
    step = np.repeat(sizes, sizes)
    for plane in planes:
        data[at] = plane
        at += step
    found = pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(np.concatenate([starts, ends[-1:]]).astype(np.int32)), pa.py_buffer(data)])
    return pc.if_else(lists.is_null(), pa.scalar(None, pa.binary()), found) if lists.null_count else found


def unpack(packed: pa.Array) -> pa.ListArray:
    """The lists behind the values that ``pack`` gave."""
    sizes = pc.fill_null(pc.binary_length(packed), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [_unpacked(packed.slice(run.start, run.stop - run.start), sizes[run]) for run in _runs(sizes)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def _unpacked(packed: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    data = np.frombuffer(b"".join(x for x in packed.to_pylist() if x is not None), np.uint8)
    starts = np.cumsum(lengths) - lengths
    marks = np.zeros(len(lengths), np.uint8)
    marks[lengths > 0] = data[starts[lengths > 0]]
    width, holed, sparse = (marks & 7).astype(np.int64), (marks & HOLED) > 0, (marks & SPARSE) > 0
    sizes = (lengths - 1) // np.maximum(width + holed, 1) * (lengths > 0)
    fixed = data[starts[sparse][:, None] + np.arange(1, 9)].reshape(-1).view("<u4").reshape(-1, 2)
    sizes[sparse] = fixed[:, 0]
    common = np.zeros(len(lengths), np.uint32)
    common[sparse] = fixed[:, 1]
    ends = np.cumsum(sizes)
    values, valid = np.zeros(int(sizes.sum()), np.uint32), np.ones(int(sizes.sum()), bool)
    for mark in np.unique(marks[lengths > 0]).tolist():
        rows = np.flatnonzero(marks == mark)
        n, at = sizes[rows], starts[rows] + 1
        to = np.repeat(ends[rows] - n - (np.cumsum(n) - n), n) + np.arange(n.sum())
        if mark & SPARSE:
            values[to] = _signed(np.repeat(common[rows], n), mark)
            eighths = (n + 7) // 8
            first = np.cumsum(eighths) - eighths
            rare = np.unpackbits(data[np.repeat(at + 8 - first, eighths) + np.arange(eighths.sum())]).astype(bool)
            rare = rare[np.repeat(8 * first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            to, n, at = to[rare], np.bincount(np.repeat(np.arange(len(rows)), n)[rare], minlength=len(rows)), at + 8 + eighths
        at, step = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum()), np.repeat(n, n)
        found = np.zeros(len(to), np.uint32)
        for k in range(mark & 7):
            found |= data[at].astype(np.uint32) << np.uint32(8 * k)
            at = at + step
        values[to] = _signed(found, mark)
        if mark & HOLED:
            valid[to] = data[at] > 0
    items = pa.array(values.view(np.int32), pa.int32(), mask=None if valid.all() else ~valid)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), items, mask=packed.is_null())


def _signed(bits: np.ndarray, mark: int) -> np.ndarray:
    return bits >> 1 ^ -(bits & 1) if mark & SIGNED else bits


@F.arrow_udf(T.BinaryType())
def _pack(lists: pa.Array) -> pa.Array:
    return pack(lists)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _unpack(packed: pa.Array) -> pa.Array:
    return unpack(packed)


def compact(values: Column | str) -> Column:
    """A list of integers as one short binary value."""
    return _pack(values)


def spread_out(packed: Column | str) -> Column:
    """The list behind ``compact``."""
    return _unpack(packed)
