"""Vector codes by product quantisation, learnt with active-entry Lloyd rounds on integers.

A vector is cut into equal parts and every part is named by the nearest entry of its position's
codebook. All arithmetic is on integers, so a result does not depend on the order of rows or tasks.

Each row keeps, per part, the entry it was given and the exact distance to it. After the entries were
replaced by means, the driver tells which of them moved. A part whose own entry stayed compares that
stored distance with the moved entries alone, since no other distance changed; a part whose entry moved
scans the whole codebook. Equal distances go to the lower index in both cases.

Rows travel as blocks (ids, labels, a matrix, the state, and the block's sums per entry). A round reads
the blocks of the round before and writes new ones, which also cuts lineage; only sums are shuffled, and
the driver sees one row per codebook component. The rows themselves never move.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, bounded_batches, drop, per_batch, renamed, settle, settled

SCALE = 4096.0
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMIT = 1 << 27  # of a component's magnitude: the squares of a part then add up exactly


def whole_numbers(vectors: pa.ListArray, length: int, scale: float = SCALE) -> np.ndarray:
    """``floor(scale * x)`` as an ``(n, length)`` matrix; shorter vectors end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), length), np.int32)
    row = np.repeat(np.arange(len(vectors)), sizes)
    column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out[row, column] = np.clip(np.floor(values * scale), -LIMIT, LIMIT)
    return out


def distances(part: np.ndarray, entry: np.ndarray) -> np.ndarray:
    apart = part - entry
    return np.einsum("ij,ij->i", apart, apart)


def scan(part: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and its distance; ties to the lower index."""
    best = distances(part, codebook[0])
    index = np.zeros(len(part), np.uint8)
    for e in range(1, len(codebook)):
        found = distances(part, codebook[e])
        nearer = found < best
        best[nearer], index[nearer] = found[nearer], e
    return index, best


def compare_moved(part: np.ndarray, codebook: np.ndarray, moved: np.ndarray, index: np.ndarray,
                  best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``scan`` for parts whose entry ``index`` stayed at the distance ``best``."""
    index, best = index.copy(), best.copy()
    for e in np.flatnonzero(moved):
        found = distances(part, codebook[e])
        nearer = (found < best) | ((found == best) & (e < index))
        best[nearer], index[nearer] = found[nearer], e
    return index, best


def assign(matrix: np.ndarray, codebooks: np.ndarray, moved: np.ndarray | None = None,
           index: np.ndarray | None = None, best: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Entries and distances ``(n, parts)`` for a matrix ``(n, length)``; without a state all parts are scanned."""
    parts, _, width = codebooks.shape
    cut = matrix.reshape(len(matrix), parts, width)
    new_index = np.zeros((len(matrix), parts), np.uint8)
    new_best = np.zeros((len(matrix), parts), np.int64)
    for p in range(parts):
        values = np.ascontiguousarray(cut[:, p], np.int64)
        if moved is None:
            new_index[:, p], new_best[:, p] = scan(values, codebooks[p])
            continue
        stale = moved[p][index[:, p]]
        for rows, work in ((np.flatnonzero(stale), scan), (np.flatnonzero(~stale), None)):
            if not len(rows):
                continue
            found = work(values[rows], codebooks[p]) if work else compare_moved(
                values[rows], codebooks[p], moved[p], index[rows, p], best[rows, p])
            new_index[rows, p], new_best[rows, p] = found
    return new_index, new_best


def block_sums(matrix: np.ndarray, index: np.ndarray, entries: int) -> np.ndarray:
    """Counts, then component sums, by part and entry. Sums of a block stay far below 2**53, so doubles hold them."""
    parts = index.shape[1]
    cut = matrix.reshape(len(matrix), parts, -1)
    width = cut.shape[2]
    counts = np.stack([np.bincount(index[:, p], minlength=entries) for p in range(parts)])
    sums = np.stack([
        np.stack([np.bincount(index[:, p], cut[:, p, j], minlength=entries) for j in range(width)], axis=1)
        for p in range(parts)]) if width else np.zeros((parts, entries, 0))
    return np.concatenate([counts.ravel(), sums.ravel().astype(np.int64)]).astype(np.int64)


def _block(ids: pa.Array, labels: pa.Array, matrix: np.ndarray, index: np.ndarray, best: np.ndarray,
           entries: int) -> pa.RecordBatch:
    def one(column: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

    return pa.RecordBatch.from_arrays(
        [one(ids), one(labels), *(pa.array([a.tobytes()], pa.binary()) for a in (matrix, index, best)),
         pa.array([block_sums(matrix, index, entries)], pa.list_(pa.int64()))],
        names=["ids", "labels", "matrix", "entry", "distance", "sums"])


def _first_round(codebooks: np.ndarray, length: int, scale: float):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        matrix = whole_numbers(batch.column("vector"), length, scale)
        return _block(batch.column("id"), batch.column("label"), matrix, *assign(matrix, codebooks), codebooks.shape[1])
    return per_batch(run)


def _state(batch: pa.RecordBatch, i: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]:
    ids, labels = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "labels"))
    matrix = np.frombuffer(batch.column("matrix")[i].as_py(), np.int32).reshape(len(ids), -1)
    index = np.frombuffer(batch.column("entry")[i].as_py(), np.uint8).reshape(len(ids), parts)
    best = np.frombuffer(batch.column("distance")[i].as_py(), np.int64).reshape(len(ids), parts)
    return matrix, index, best, ids, labels


def _next_round(codebooks: np.ndarray, moved: np.ndarray):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for i in range(batch.num_rows):
            matrix, index, best, ids, labels = _state(batch, i, len(codebooks))
            index, best = assign(matrix, codebooks, moved, index, best)
            out.append(_block(ids, labels, matrix, index, best, codebooks.shape[1]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    return per_batch(run)


def _coded(codebooks: np.ndarray, moved: np.ndarray):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for i in range(batch.num_rows):
            matrix, index, best, ids, labels = _state(batch, i, len(codebooks))
            index, best = assign(matrix, codebooks, moved, index, best)
            codes = [row.tobytes().hex() for row in index]
            out.append(pa.RecordBatch.from_arrays(
                [ids, labels, pa.array(codes, pa.string()), pa.array(best.sum(axis=1), pa.int64())],
                names=["id", "label", "code", "error"]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    return per_batch(run)


def _means(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Entries as floored means of their parts; unused ones stay."""
    parts, entries, width = codebooks.shape
    total = np.zeros(parts * entries * (1 + width), np.int64)
    summed = blocks.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
    for row in summed.collect():  # one row per codebook component
        total[row["at"]] = row["value"]
    counts = total[:parts * entries].reshape(parts, entries, 1)
    sums = total[parts * entries:].reshape(codebooks.shape)
    return np.where(counts > 0, sums // np.maximum(counts, 1), codebooks)


def codebooks_text(codebooks: np.ndarray) -> str:
    return ",".join(map(str, codebooks.ravel().tolist()))


def _usable(vector: Column) -> Column:
    def broken(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, broken)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: float = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error)`` of every usable row, and the codebooks ``(parts, entries, width)``.

    Null vectors and those with a null or non-finite component are left out. Vectors shorter than the longest,
    rounded up to a multiple of ``parts``, count as ended by zeros. ``floor(scale * x)`` beyond ``LIMIT`` in
    magnitude counts as ``LIMIT``. Codebooks begin with the rows of the smallest ids; equal ids follow their
    vectors and rows without an id come last. With fewer rows than ``entries`` there are as many entries as rows.
    Repeated rows count each time and an empty table gives none. Other columns are ignored. An entry number is one byte.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    bounded_batches(vectors.sparkSession)
    rows = renamed(vectors, id=id_col, label=label_col, vector=vector_col).where(_usable(F.col("vector"))) \
        .withColumn("id", F.col("id").cast("bigint")).withColumn("vector", F.col("vector").cast("array<double>"))
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    first = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").toArrow()  # ``entries`` rows
    width = -(-max(longest or 0, 1) // parts)
    kept = "id bigint, label {0}, code string, error bigint".format(rows.schema["label"].dataType.simpleString())
    if not first.num_rows:
        return vectors.sparkSession.createDataFrame([], kept), np.zeros((parts, 0, width), np.int64)
    seeds = whole_numbers(first.column("vector").combine_chunks(), parts * width, scale)
    codebooks = seeds.reshape(len(seeds), parts, width).transpose(1, 0, 2).astype(np.int64)
    fields = "ids array<bigint>, labels array<{0}>, matrix binary, entry binary, distance binary, sums array<bigint>".format(
        rows.schema["label"].dataType.simpleString())
    blocks, path = settled(rows.mapInArrow(_first_round(codebooks, parts * width, scale), fields), "codes-1")
    moved = None
    for turn in range(1, rounds + 1):
        means = _means(blocks, codebooks)
        moved, codebooks = (means != codebooks).any(axis=2), means
        if turn == rounds or not moved.any():  # without a moved entry all later rounds are alike
            break
        state = blocks.drop("sums").mapInArrow(_next_round(codebooks, moved), fields)
        blocks, next_path = settled(state, f"codes-{turn + 1}")
        drop(vectors.sparkSession, path)
        path = next_path
    if moved is None:
        moved = np.zeros(codebooks.shape[:2], bool)
    out = settle(blocks.drop("sums").mapInArrow(_coded(codebooks, moved), kept), "coded")
    drop(vectors.sparkSession, path)
    return out, codebooks


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the error summed over equal labels; null labels are equal.

    Sums are combined before the shuffle. Up to ``BROADCAST_IDS`` labels, counted first, are broadcast; more are joined.
    """
    sums = settle(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "labels")
    few = sums.count() <= BROADCAST_IDS
    return coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``; rows as in ``compress``.

    ``code`` has two hexadecimal digits per part. ``codebooks_sha256`` is of the entries' decimal components,
    joined by commas.
    """
    coded, codebooks = compress(vectors, id_col, vector_col, label_col, parts, entries, rounds)
    digest = hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
    return with_label_errors(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def decode(coded: DataFrame, codebooks: np.ndarray, scale: float = SCALE) -> DataFrame:
    """Add ``approximation``: the vector that a ``code`` stands for, at the middle of its integer steps."""
    tables = [F.array(*[F.array(*map(F.lit, entry)) for entry in part]) for part in ((codebooks + 0.5) / scale).tolist()]
    entry = [F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") for p in range(len(codebooks))]
    return coded.withColumn("approximation", F.concat(*[tables[p][e] for p, e in enumerate(entry)]))
