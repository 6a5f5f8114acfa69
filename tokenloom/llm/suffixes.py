"""Removal of byte strings that also start in an earlier document, by sorted suffix runs.

A string of ``span`` bytes is one window of ``span - GRAM + 1`` starts of ``GRAM``-byte grams.
Anchors are the positions that hold the smallest gram hash of some window, so equal strings have
equal anchors, and a suffix array over anchors alone sees every repeated string.

1. Gram hashes of all anchors are exchanged as packed columns, four bytes each beside the position.
   A bucket sorts its hashes; only anchors whose hash occurs in two different texts go on, and
   of equal texts only the one with the smallest id. Its later copies go whole.
2. Their suffixes are cut at ``span`` bytes, with the ``span - GRAM`` bytes before the anchor. Equal
   contexts of a run are one record with all its places. Runs are sorted, front-coded
   (length shared with the record before, then the rest) and exchanged by gram hash.
3. Each part merges its runs with a loser tree that carries common-prefix lengths: of two
   suffixes the one sharing more with the last winner is smaller, and bytes are compared only
   beyond a shared length. Neighbours that share a gram are resolved window by window.
4. The windows to remove are joined to the texts.

Very frequent grams (``HOT`` occurrences) do not enter a run, so that what meets in a task is bounded:
their windows are rows, grouped with partial aggregation and joined back.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, fresh, mix64, per_batch, renamed, settle, tidy

SPAN = 50
GRAM = 16
HOT = 100_000
BUCKET_ANCHORS = 250_000
GROUP_ANCHORS = 2_000_000
PART_RECORDS = 100_000
RUN_RECORDS = 100_000
FLUSH_BYTES = 4 << 20
HOT_BIT = np.uint32(1 << 31)  # of a place; a text has fewer bytes
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all ``size``-byte grams, by doubling."""
    if len(data) < size:
        return np.empty(0, np.uint64)
    powers = {1: mix64(data.astype(np.uint64) + np.uint64(1))}
    width = 1
    while width * 2 <= size:
        h = powers[width]
        powers[width * 2] = h[:len(h) - width] * _C1 + (h[width:] ^ (h[width:] >> np.uint64(29))) * _C2
        width *= 2
    acc, covered = powers[width][:len(data) - size + 1], width
    n = len(acc)
    while covered < size:
        width = max(w for w in powers if w <= size - covered)
        acc = (acc ^ (acc >> np.uint64(31))) * _C1 + powers[width][covered:covered + n]
        covered += width
    return mix64(acc)


def _sliding(values: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over each window of ``width`` values, by doubling."""
    have, acc = 1, values
    while have * 2 <= width:
        acc = op(acc[:len(acc) - have], acc[have:])
        have *= 2
    return op(acc[:len(values) - width + 1], acc[width - have:][:len(values) - width + 1]) if have < width else acc


def anchors(data: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose gram hash is the smallest of some window, and the hashes."""
    if len(data) < span:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(data, gram)
    width = span - gram + 1
    low = _sliding(h, width, np.minimum)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(h == _sliding(padded, width, np.maximum))
    return chosen, h[chosen]


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal rank side by side, which compresses better."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplanes(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(blob, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


_BLOBS = "bucket int, docs binary, texts binary, counts binary, places binary, hashes binary"


def _anchor_blobs(span: int, gram: int, bits: int):
    schema = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("docs", "texts", "counts", "places", "hashes")])

    def flush(held: list) -> pa.RecordBatch:
        doc = np.repeat(np.arange(len(held)), [len(x[2]) for x in held])
        place = np.concatenate([x[2] for x in held]).astype(np.uint32)
        full = np.concatenate([x[3] for x in held])
        ids = np.array([x[0] for x in held], np.int64)
        texts = np.array([x[1] for x in held], np.int64)
        bucket = (full >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(full), np.int64)
        order = np.argsort(bucket, kind="stable")
        doc, place, full, bucket = doc[order], place[order], full[order], bucket[order]
        rest = (full >> np.uint64(32 - bits)).astype(np.uint32)
        rows = []
        edges = np.flatnonzero(np.diff(bucket)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(bucket)], strict=True):
            own, counts = np.unique(doc[lo:hi], return_counts=True)
            gaps = np.diff(place[lo:hi], prepend=np.uint32(0))
            rows.append((int(bucket[lo]), _planes(ids[own]), _planes(texts[own]), _planes(counts.astype(np.uint32)),
                         _planes(gaps), _planes(rest[lo:hi])))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, text_hash, text in zip(batch.column("id").to_pylist(), batch.column("text_hash").to_pylist(),
                                               as_bytes(batch.column("text")), strict=True):
                if doc_id is None or text is None or len(text) < span:
                    continue
                at, h = anchors(np.frombuffer(text, np.uint8), span, gram)
                held.append((doc_id, text_hash, at, h))
                size += len(text)
                if size >= FLUSH_BYTES:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
    return run


def _repeated(hot: int, groups: int):
    """One bucket's blobs -> its anchors whose hash occurs in two texts, for the first document of each text.

    They go back packed, one row per group of texts.
    """
    def run(table: pa.Table) -> pa.Table:
        docs, texts, which, places, hashes = [], [], [], [], []
        base = 0
        for row in table.to_pylist():
            ids, counts = _unplanes(row["docs"], np.int64), _unplanes(row["counts"], np.uint32)
            docs.append(ids)
            texts.append(_unplanes(row["texts"], np.int64))
            which.append(np.repeat(np.arange(base, base + len(ids)), counts))
            places.append(np.cumsum(_unplanes(row["places"], np.uint32), dtype=np.uint32))
            hashes.append(_unplanes(row["hashes"], np.uint32))
            base += len(ids)
        docs, texts, which, places, hashes = map(np.concatenate, (docs, texts, which, places, hashes))
        order = np.argsort(hashes, kind="stable")
        # Equal texts have equal anchors, so a bucket sees all copies of what it holds.
        _, text, copies = np.unique(texts, return_inverse=True, return_counts=True)
        first = np.full(len(copies), np.iinfo(np.int64).max)
        np.minimum.at(first, text, docs)
        lead = docs == first[text]
        h, d = hashes[order], text[which[order]]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        low, high = np.minimum.reduceat(d, starts), np.maximum.reduceat(d, starts)
        sizes = np.diff(np.append(starts, len(h)))
        repeated, frequent = np.repeat(low != high, sizes), np.repeat(sizes >= hot, sizes)
        chosen = np.sort(order[repeated & lead[which[order]]])
        places[order[frequent]] |= HOT_BIT
        return _packed(docs[which[chosen]], texts[which[chosen]], places[chosen], groups)
    return run


def _runs_of(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings equal ``(id, text hash)`` together, and where each begins in it."""
    order = np.lexsort((hashes, ids))
    a, b = ids[order], hashes[order]
    return order, np.flatnonzero(np.concatenate([[len(a) > 0], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[:len(a)])


_PACKED = "texts_group int, docs binary, texts binary, counts binary, found binary"


def _packed(ids: np.ndarray, hashes: np.ndarray, values: np.ndarray, groups: int) -> pa.Table:
    """Values by text -> one row per group of texts, as packed columns; a text belongs to the group of its hash."""
    target = hashes % groups
    order = np.lexsort((hashes, ids, target))
    ids, hashes, values = ids[order], hashes[order], values[order]
    starts = np.flatnonzero(np.concatenate([[len(ids) > 0], (np.diff(ids) != 0) | (np.diff(hashes) != 0)])[:len(ids)])
    ends = np.append(starts[1:], len(ids)).astype(np.int64)
    target = target[order][starts]
    edges = np.flatnonzero(np.diff(target)) + 1
    rows = []
    for lo, hi in zip([0, *edges], [*edges, len(starts)], strict=True):
        if hi > lo:
            own = starts[lo:hi]
            rows.append((int(target[lo]), _planes(ids[own]), _planes(hashes[own]),
                         _planes((ends[lo:hi] - own).astype(np.uint32)), _planes(values[own[0]:ends[hi - 1]])))
    schema = pa.schema([("texts_group", pa.int32())] + [(n, pa.binary()) for n in ("docs", "texts", "counts", "found")])
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, schema, strict=True)], schema=schema)


def _unpacked(table: pa.Table, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of one group -> id, text hash and value, one of each per value."""
    parts = []
    for row in table.to_pylist():
        counts = _unplanes(row["counts"], np.uint32)
        parts.append((np.repeat(_unplanes(row["docs"], np.int64), counts), np.repeat(_unplanes(row["texts"], np.int64), counts),
                      _unplanes(row["found"], kind)))
    ids, hashes, values = (np.concatenate(c) for c in zip(*parts, strict=True))
    return ids, hashes, values


def _gathered(table: pa.Table) -> pa.Table:
    """The packed anchors of one group of texts, from all buckets -> one row per text."""
    ids, texts, places = _unpacked(table, np.uint32)
    order, starts = _runs_of(ids, texts)
    parts = np.split(places[order], starts[1:])
    return pa.table({
        "id": pa.array(ids[order][starts], pa.int64()), "text_hash": pa.array(texts[order][starts], pa.int64()),
        "places": pa.array([p.tobytes() for p in parts], pa.binary()),
        "hot": pa.array([bool((p >= HOT_BIT).any()) for p in parts], pa.bool_())})


def _gathered_windows(table: pa.Table) -> pa.Table:
    """The packed windows of one group of texts, from all parts -> one row per text."""
    return pa.table(_by_text(*_unpacked(table, np.int64)), schema=_BY_TEXT)


def _by_text(ids: np.ndarray, hashes: np.ndarray, windows: np.ndarray) -> list[pa.Array]:
    """Columns ``id, text_hash, windows`` with one row per text."""
    order, starts = _runs_of(ids, hashes)
    offsets = pa.array(np.append(starts, len(ids)), pa.int32())
    return [pa.array(ids[order][starts], pa.int64()), pa.array(hashes[order][starts], pa.int64()),
            pa.ListArray.from_arrays(offsets, pa.array(windows[order], pa.int64()))]


_BY_TEXT = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("windows", pa.list_(pa.int64()))])
_PLACE = np.dtype([("id", "<i8"), ("text_hash", "<i8"), ("place", "<i8")])


def _late(span: int, gram: int):
    """Windows of frequent grams with the smallest id that has them -> the places in later documents, by text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = [np.frombuffer(x, _PLACE) for x in as_bytes(batch.column("held"))]
        later = [h[h["id"] > low] for h, low in zip(held, batch.column("least").to_pylist(), strict=True)]
        found = np.concatenate(later)
        window = (found["place"] << np.int64(span - gram + 1)) + np.int64(1)
        return pa.RecordBatch.from_arrays(_by_text(found["id"], found["text_hash"], window), schema=_BY_TEXT)
    return per_batch(run)


def front_code(records: list[tuple[bytes, bytes, list[tuple[int, int]]]], docs: list[tuple[int, int]]) -> bytes:
    """Sorted ``(suffix, left, places)`` as one compressed run.

    A suffix is the length shared with the one before and the rest; a place is a number into ``docs``,
    pairs of id and text hash of which the run holds those it names, and a position.
    """
    number: dict[int, int] = {}
    out, before = [], b""
    for suffix, left, places in records:
        shared = _common(before, suffix)
        out += bytes((shared, len(suffix) - shared, len(left))), suffix[shared:], left, struct.pack("<I", len(places))
        out += (struct.pack("<II", number.setdefault(doc, len(number)), at) for doc, at in places)
        before = suffix
    table = [struct.pack("<I", len(number)), *(struct.pack("<qq", *docs[doc]) for doc in number)]
    return zlib.compress(b"".join(table + out), 6)


def front_decode(run: bytes) -> Iterator[tuple[bytes, bytes, list[tuple[int, int, int]], int]]:
    """``(suffix, left, places, length shared with the record before)``; a place is id, text hash, position."""
    run = zlib.decompress(run)
    at = 4 + 16 * int.from_bytes(run[:4], "little")
    docs = list(struct.iter_unpack("<qq", run[4:at]))
    suffix = b""
    while at < len(run):
        shared, rest, left = run[at], run[at + 1], run[at + 2]
        at += 3
        suffix = suffix[:shared] + run[at:at + rest]
        at += rest
        places = at + left + 4
        end = places + 8 * int.from_bytes(run[at + left:places], "little")
        yield suffix, run[at:at + left], [(*docs[d], p) for d, p in struct.iter_unpack("<II", run[places:end])], shared
        at = end


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() + 7) // 8


def merge_runs(runs: list[bytes]) -> Iterator[tuple[bytes, bytes, list, int]]:
    """Loser-tree merge of front-coded runs; yields records with the length shared with the last.

    Every head carries the length it shares with the last winner. The longer one is smaller;
    bytes are compared only when lengths are equal, from there on, and the loser keeps
    the length it shares with the winner.
    """
    width = 1 << max(0, len(runs) - 1).bit_length()
    sources = [front_decode(r) for r in runs]
    heads: list = [next(s, None) for s in sources] + [None] * (width - len(runs))
    shared = [0] * width

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); lowers the loser's shared length to what it shares with the winner."""
        a, b = heads[x], heads[y]
        if b is None:
            return x, y
        if a is None:
            return y, x
        if shared[x] != shared[y]:
            return (x, y) if shared[x] > shared[y] else (y, x)
        from_ = shared[x]
        p, q = a[0][from_:], b[0][from_:]
        length = from_ + _common(p, q)
        if p <= q:
            shared[y] = length
            return x, y
        shared[x] = length
        return y, x

    losers = [0] * width
    winners = [0] * width + list(range(width))
    for node in range(width - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if width > 1 else 0
    while heads[top] is not None:
        suffix, left, places, _ = heads[top]
        yield suffix, left, places, shared[top]
        heads[top] = following = next(sources[top], None)
        if following is not None:
            shared[top] = following[3]
        node = (top + width) // 2
        while node:
            top, losers[node] = play(losers[node], top)
            node //= 2


def resolve(group: list[tuple[bytes, bytes, int, int]], span: int, gram: int) -> list[int]:
    """Per context of one gram, the windows (bit: bytes before the anchor) that start in an earlier document.

    Suffixes are in order, so the longest prefix a context shares with any other is the
    larger of those with its neighbours; windows that would need more are not looked up.
    """
    masks = [0] * len(group)
    if len(group) < 2:
        return masks
    reach = [max(group[i][3] if i else 0, group[i + 1][3] if i + 1 < len(group) else 0) for i in range(len(group))]
    first: dict[tuple[int, bytes], int] = {}
    seen = []
    for (suffix, left, doc, _), longest in zip(group, reach, strict=True):
        own = []
        for j in range(max(0, span - longest), min(span - gram, len(left)) + 1):
            if len(suffix) >= span - j:
                key = (j, left[len(left) - j:] + suffix[:span - j])
                own.append(key)
                if doc < first.get(key, doc + 1):
                    first[key] = doc
        seen.append(own)
    for i, own in enumerate(seen):
        for key in own:
            if first[key] < group[i][2]:
                masks[i] |= 1 << key[0]
    return masks


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, np.ndarray, np.ndarray]]:
    for batch in batches:
        for doc, text_hash, text, places in zip(batch.column("id").to_pylist(), batch.column("text_hash").to_pylist(),
                                                as_bytes(batch.column("text")), batch.column("places").to_pylist(), strict=True):
            at = np.frombuffer(places, np.uint32)
            yield doc, text_hash, text, (at & ~HOT_BIT).astype(np.int64), at >= HOT_BIT


def _contexts(span: int, gram: int, parts: int):
    """Texts with their candidate anchors -> sorted, front-coded runs by part, and windows of very frequent grams.

    Equal windows of a batch are one row, with the smallest and largest id and all places.
    """
    schema = pa.schema([("part", pa.int32()), ("run", pa.binary()), ("key", pa.binary()), ("low", pa.int64()),
                        ("high", pa.int64()), ("held", pa.binary())])

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name) or [None] * n, f.type) for f in schema], schema=schema)

    def flush(records: dict, docs: list) -> pa.RecordBatch:
        by_part: dict[int, list] = {}
        for (suffix, left), places in records.items():
            by_part.setdefault(xxhash.xxh3_64_intdigest(suffix[:gram]) % parts, []).append((suffix, left, places))
        for own in by_part.values():
            own.sort()
        return rows(part=list(by_part), run=[front_code(own, docs) for own in by_part.values()])

    def flush_windows(windows: dict) -> pa.RecordBatch:
        held = [np.array(places, _PLACE) for places in windows.values()]
        return rows(key=list(windows), low=[int(h["id"].min()) for h in held], high=[int(h["id"].max()) for h in held],
                    held=[h.tobytes() for h in held])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: dict[tuple[bytes, bytes], list] = {}
        windows: dict[bytes, list[tuple[int, int, int]]] = {}
        docs: list[tuple[int, int]] = []
        size = held = 0
        for doc, text_hash, text, at, hot in _candidates(batches):
            for p in at[~hot].tolist():
                records.setdefault((text[p:p + span], text[max(0, p - span + gram):p]), []).append((len(docs), p))
            docs.append((doc, text_hash))
            size += len(at)
            if size >= RUN_RECORDS:
                yield flush(records, docs)
                records, docs, size = {}, [], 0
            start = np.unique((at[hot][:, None] - np.arange(span - gram + 1)).ravel())
            start = start[(start >= 0) & (start <= len(text) - span)].tolist()
            for p in start:
                windows.setdefault(xxhash.xxh3_128_digest(text[p:p + span]), []).append((doc, text_hash, p))
            held += len(start)
            if held >= RUN_RECORDS:
                yield flush_windows(windows)
                windows, held = {}, 0
        if records:
            yield flush(records, docs)
        if windows:
            yield flush_windows(windows)
    return run


def _merged(span: int, gram: int, groups: int):
    every = (1 << (span - gram + 1)) - 1

    def run(table: pa.Table) -> pa.Table:
        ids, hashes, windows = [], [], []

        def close(group: list) -> None:
            for (_, _, low, _), mask, places in zip(group, resolve(group, span, gram), held, strict=True):
                for doc, text_hash, place in places:
                    own = every if doc > low else mask
                    if own:
                        ids.append(doc)
                        hashes.append(text_hash)
                        windows.append(place << (span - gram + 1) | own)

        group: list = []
        held: list[list[tuple[int, int, int]]] = []
        same: dict[bytes, int] = {}
        for suffix, left, places, shared in merge_runs(table.column("run").to_pylist()):
            low = min(p[0] for p in places)
            if shared < gram:
                close(group)
                group, held, same = [], [], {}
            elif shared < len(suffix) or len(group[-1][0]) != len(suffix):
                same = {}
            if left in same:  # the same context from another run
                at = same[left]
                held[at] += places
                group[at] = (*group[at][:2], min(low, group[at][2]), group[at][3])
                continue
            same[left] = len(group)
            group.append((suffix, left, low, shared if group else 0))
            held.append(places)
        close(group)
        return _packed(*(np.array(c, np.int64) for c in (ids, hashes, windows)), groups)
    return run


def cover(intervals: np.ndarray) -> list[tuple[int, int]]:
    """The union of ``(start, end)`` rows as maximal runs."""
    if not len(intervals):
        return []
    order = intervals[np.argsort(intervals[:, 0], kind="stable")]
    reach = np.maximum.accumulate(order[:, 1])
    new = np.concatenate([[True], order[1:, 0] > reach[:-1]])
    starts = order[new, 0]
    ends = reach[np.append(np.flatnonzero(new)[1:] - 1, len(order) - 1)]
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """``(text_hash, first, windows)`` for texts of which something is repeated.

    ``first`` is the smallest id of the text, for which the windows hold: anchors, shifted, with a mask of
    window starts before them. Rows of the text with larger ids are repeated as a whole.

    A byte is to go when a ``span``-byte string over it also starts in a row with a smaller id. Rows
    without an id or a text, and texts shorter than ``span`` bytes, have none and give none.
    """
    bounded_batches(docs.sparkSession)
    texts = _hashed(docs, id_col, text_col)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = total * 2 / (span - gram + 2)
    bits = min(24, max(0, math.ceil(math.log2(max(1, expected / BUCKET_ANCHORS)))))
    buckets = texts.mapInArrow(tidy(_anchor_blobs(span, gram, bits)), _BLOBS)
    groups = max(1, math.ceil(expected / GROUP_ANCHORS))
    packed = buckets.repartition(1 << bits, "bucket").groupBy("bucket").applyInArrow(tidy(_repeated(hot, groups)), _PACKED)
    per_text = settle(packed.groupBy("texts_group").applyInArrow(
        tidy(_gathered), "id bigint, text_hash bigint, places binary, hot boolean"), "anchors")
    n, any_hot = per_text.agg(F.sum(F.octet_length("places") / 4), F.max("hot")).first()
    rows = texts.join(per_text, ["id", "text_hash"]).mapInArrow(
        tidy(_contexts(span, gram, max(1, math.ceil((n or 0) / PART_RECORDS)))),
        "part int, run binary, key binary, low bigint, high bigint, held binary")
    if any_hot:  # both kinds of rows are read
        rows = settle(rows, "contexts")
    by_text = "id bigint, text_hash bigint, windows array<bigint>"
    packed = rows.where("part IS NOT NULL").select("part", "run").groupBy("part").applyInArrow(
        tidy(_merged(span, gram, groups)), _PACKED)
    found = packed.groupBy("texts_group").applyInArrow(tidy(_gathered_windows), by_text)
    if any_hot:
        windows = rows.where("part IS NULL").select("key", "low", "high", "held")
        lows = windows.groupBy("key").agg(F.min("low").alias("least"), F.max("high").alias("most")) \
            .where("least < most").select("key", "least")
        found = found.union(windows.join(lows, "key").where("high > least").mapInArrow(_late(span, gram), by_text))
    copied = texts.where((F.octet_length("text") >= span) & F.col("id").isNotNull()).groupBy("text_hash").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return found.union(copied.select("id", "text_hash", F.lit(None).cast("array<bigint>"))).groupBy("text_hash").agg(
        F.min("id").alias("first"), F.flatten(F.collect_list("windows")).alias("windows"))


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text_hash, text)``; the hash tells texts under one id apart."""
    texts = renamed(docs, id=id_col, text=text_col)
    return texts.select(F.col("id").cast("bigint").alias("id"), F.xxhash64("text").alias("text_hash"), "text")


def _to_spans(windows: np.ndarray, size: int, span: int, gram: int) -> list[tuple[int, int]]:
    """Anchors with masks of starts before them -> maximal byte runs within the text."""
    bits = span - gram + 1
    place = windows >> np.int64(bits)
    starts = [place[(windows >> np.int64(j)) & np.int64(1) == 1] - j for j in range(bits)]
    start = np.unique(np.concatenate(starts))
    start = start[(start >= 0) & (start + span <= size)]
    return cover(np.stack([start, start + span], axis=1))


def _split(batch: pa.RecordBatch, id_: str, text: str, first: str, windows: str, span: int,
           gram: int) -> Iterator[tuple[bytes, list[int], bytes]]:
    """Per row: the bytes, edges of the removed runs, the bytes kept."""
    found = batch.column(windows)
    for i, (doc, low, whole) in enumerate(zip(
            batch.column(id_).to_pylist(), batch.column(first).to_pylist(), as_bytes(batch.column(text)), strict=True)):
        whole, runs = whole or b"", []
        if doc is not None and low is not None and len(whole) >= span:
            if doc > low:
                runs = [(0, len(whole))]
            elif len(own := found[i].values):
                runs = _to_spans(own.to_numpy(), len(whole), span, gram)
        spans = [x for r in runs for x in r]
        edges = [0, *spans, len(whole)]
        yield whole, spans, b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                   gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, spans, kept``.

    ``kept`` holds the bytes of the text without those that a ``span``-byte string covers which also
    starts in a document with a smaller id; ``spans`` lists starts and ends of the removed runs. Null
    texts count as empty. Repeated rows of one id do not remove each other. A row without an id
    loses nothing and removes nothing. Other columns are ignored; an empty table gives none.
    """
    windows = repeated_spans(docs, id_col, text_col, span, gram, hot)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.int64())), ("kept", pa.binary())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole, spans, kept = zip(*_split(batch, "id", "text", "first", "windows", span, gram))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(c, f.type) for c, f in zip((map(len, whole), spans, kept), list(schema)[1:], strict=True))],
            schema=schema)

    return _hashed(docs, id_col, text_col).join(windows, "text_hash", "left").mapInArrow(
        per_batch(run), "doc_id bigint, n_bytes bigint, spans array<bigint>, kept binary")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                    gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text; the other columns stay.

    Rules as in ``remove_repeats``. Characters cut in two are dropped, an integer column ``n_chars`` is
    counted anew where the text changed, and rows that lost their whole text go.
    """
    names = docs.columns
    digest, first, windows = (fresh(n, names) for n in ("_text_hash", "_first", "_windows"))
    found = repeated_spans(docs, id_col, text_col, span, gram, hot).select(
        F.col("text_hash").alias(digest), F.col("first").alias(first), F.col("windows").alias(windows))
    joined = docs.join(found, F.xxhash64(docs[text_col]) == F.col(digest), "left").drop(digest)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        before = batch.column(text_col).to_pylist()
        text = [b if not spans else kept.decode("utf-8", "ignore") for b, (_, spans, kept) in zip(
            before, _split(batch, id_col, text_col, first, windows, span, gram), strict=True)]
        columns = [batch.column(n) for n in names]
        columns[names.index(text_col)] = pa.array(text, batch.column(text_col).type)
        if "n_chars" in names and pa.types.is_integer(batch.column("n_chars").type):
            at = names.index("n_chars")
            columns[at] = pa.array([old if t is b else len(t) for old, t, b in zip(
                columns[at].to_pylist(), text, before, strict=True)], columns[at].type)
        keep = pa.array([t != "" or b == "" for t, b in zip(text, before, strict=True)])
        return pa.RecordBatch.from_arrays(columns, names=names).filter(keep)

    return joined.mapInArrow(per_batch(run), docs.schema)
