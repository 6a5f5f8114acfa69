"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest pivots in order. Every pair of its first ``NEAR`` pivots is an
inverted list, so two vectors of one list share two pivots at least; they are counted in the first
list they share, and verified by cosine in double precision. Pivots are a bounded sample without neighbours,
so that a dense group has one pivot, which all of it shares, and not a share of them; every
vector is indexed. Equal vectors are one entry with a multiplicity. Long lists are cut into blocks and compared
block by block as matrix products: a block pair returns link counts and a spanning forest,
never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, components, renamed, settle, tidy

NEAR = 5  # with 128 pivots; one more each time they double
SHARED = 2
BLOCK = 512
MAX_PIVOTS = 1024
CANDIDATES = 4  # for each pivot
WHOLE = 256  # as many vectors of one length are one list
PLACE = 16  # bits of a pivot's number within a key, above them the number of components


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as doubles; null, zero and non-finite ones have none."""
    for batch in batches:
        digests, packed = [], []
        for v in batch.column("vector").to_pylist():
            array = None if v is None or not v or None in v else np.array(v, np.float64)
            good = array is not None and np.isfinite(array).all() and array.any()
            if good:
                norm = math.sqrt(float(array @ array))
                good = 0 < norm < math.inf
            packed.append((array + 0.0).tobytes() if good else None)
            digests.append(xxhash.xxh3_128_digest(packed[-1]) if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())], names=["id", "digest", "vector"])


def spread(candidates: np.ndarray, size: int, threshold: float) -> np.ndarray:
    """The first ``size`` candidates that are not within twice the linking angle of one before them.

    Members of one group of links lie within that angle of its pivot, however many of the rows they are.
    """
    unit = candidates / np.sqrt((candidates ** 2).sum(axis=1))[:, None]
    cap = 2 * threshold * threshold - 1 if threshold > 0 else -1.0
    nearest, chosen = np.full(len(unit), -np.inf), []
    for i, v in enumerate(unit):
        if len(chosen) < size and nearest[i] < cap:
            chosen.append(i)
            np.maximum(nearest, unit @ v, out=nearest)
    return candidates[chosen]


def nearest(pivots: int, near: int = NEAR) -> int:
    """How many pivots describe a vector: ``near`` with up to 128 of them, one more each time they double.

    A pair at the same cosine shares fewer of its nearest pivots the denser they lie.
    """
    return near + max(0, math.ceil(math.log2(max(1, pivots))) - 7)


def _described(by_length: dict[int, np.ndarray], near: int):
    """``(id, copies, vector, near, keys)``: the nearest pivots of the vector's length, and all pairs among them.

    Where there are no more pivots than that, all vectors would share all pairs: they are one list, of key 0.
    """
    index = {n: (p, np.sqrt((p ** 2).sum(axis=1)), nearest(len(p), near)) for n, p in by_length.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, keys = [], []
            for blob in batch.column("vector").to_pylist():
                v = np.frombuffer(blob, np.float64)
                order, base = [], len(v) << 2 * PLACE
                if len(v) in index:
                    pivots, norms, k = index[len(v)]
                    order = np.argsort(-(pivots @ v) / norms, kind="stable")[:k].tolist() if len(pivots) > k else []
                first.append(sorted(order))
                keys.append([base + (a << PLACE) + b for a, b in combinations(first[-1], 2)] if order else [base])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "near", "keys"])
    return run


def _pivots(unique: DataFrame, threshold: float, max_pivots: int) -> dict[int, np.ndarray]:
    """Pivots of each vector length with more than ``WHOLE`` vectors, from those of small hash."""
    counts = unique.groupBy(F.octet_length("vector").alias("bytes")).count().where(F.col("count") > WHOLE).collect()
    sizes = {r["bytes"]: min(max_pivots, max(16, 1 << math.ceil(math.log2(r["count"]) / 2))) for r in counts}
    if not sizes:
        return {}
    shares = unique.sparkSession.createDataFrame(
        [(r["bytes"], min(1.0, 1.25 * CANDIDATES * sizes[r["bytes"]] / r["count"])) for r in counts], "bytes int, share double")
    hashed = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint") / float(1 << 32)
    sample = unique.withColumn("bytes", F.octet_length("vector")).join(F.broadcast(shares), "bytes").where(hashed < F.col("share"))
    by_length: dict[int, list] = {n: [] for n in sizes}
    for r in sorted(sample.select("bytes", "digest", "vector").collect(), key=lambda r: bytes(r.digest)):
        by_length[r["bytes"]].append(np.frombuffer(r.vector, np.float64))
    return {n // 8: spread(np.stack(own[:CANDIDATES * sizes[n]]), sizes[n], threshold) for n, own in by_length.items()}


def _rows(table: pa.Table) -> tuple[np.ndarray, ...]:
    x = np.stack([np.frombuffer(b, np.float64) for b in table.column("vector").to_pylist()])
    near = np.stack([np.array(k, np.int64) for k in table.column("near").to_pylist()])
    return table.column("id").to_numpy(), table.column("copies").to_numpy(), x / np.sqrt((x * x).sum(axis=1))[:, None], near


def _met(near: np.ndarray, key: int) -> np.ndarray:
    """For each row of the list the pivots (0 or 1) by which it meets another in an earlier list: those before the second, the first apart."""
    one, two = key >> PLACE & (1 << PLACE) - 1, key & (1 << PLACE) - 1
    used, place = np.unique(near, return_inverse=True)
    member = np.zeros((len(near), len(used)), np.float32)
    np.put_along_axis(member, place.reshape(near.shape), 1, axis=1)
    return member[:, (used < two) & (used != one)]


def _compared(threshold: float):
    """One block pair of one list -> ``(id, links, root)``: linked copies of others, and a forest edge."""
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        ids, copies, x, near = _rows(table)
        key, a, b = (table.column(c)[0].as_py() for c in ("key", "a", "b"))
        block = table.column("block").to_numpy()
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        linked = x[left] @ x[right].T >= threshold
        if linked.any() and near.shape[1]:  # a pair counts in the first list that it shares
            met = _met(near, key)
            linked &= met[left] @ met[right].T == 0
        i, j = np.nonzero(linked)
        i, j = left[i], right[j]
        if a == b:
            i, j = i[i < j], j[i < j]
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        roots = ids.copy()
        while len(i):
            low = roots.copy()
            np.minimum.at(low, i, roots[j])
            np.minimum.at(low, j, roots[i])
            if (low == roots).all():
                break
            roots = low
        own = np.flatnonzero(links > 0)
        return pa.table([pa.array(ids[own]), pa.array(links[own].astype(np.int64)), pa.array(roots[own])], schema=schema)
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9,
                 near: int = NEAR, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Links are pairs with a cosine of ``threshold`` or more that share two of their ``near`` nearest
    pivots (one more each time the pivots double beyond 128). Null, empty and zero vectors and those with
    null or non-finite components link with nothing. Rows without an id have no component. Vectors of each
    length have pivots of their own, or are one list where they are few. Pivots are at most ``max_pivots``
    vectors of small hash for a length, about the square root of their number, none within twice the
    linking angle of another. Vectors that leave few such pivots share long lists, which are compared whole.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = renamed(vectors, id=id_col, vector=vector_col).select(F.col("id").cast("bigint").alias("id"), "vector")
    packed = settle(rows.mapInArrow(tidy(_valid), "id bigint, digest binary, vector binary"), "vectors")
    unique = settle(packed.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")), "unique")
    by_length = _pivots(unique, threshold, max_pivots)
    described = settle(unique.select("id", "copies", "vector").mapInArrow(
        tidy(_described(by_length, near)), "id bigint, copies bigint, vector binary, near array<int>, keys array<bigint>"), "permutations")
    keyed = described.select("id", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    listed = described.select("id", "copies", "vector", "near", F.explode("keys").alias("key")).join(sizes, "key") \
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pairs = listed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "id", "copies", "vector", "near")
    links = settle(pairs.groupBy("key", "a", "b").applyInArrow(tidy(_compared(threshold)), "id bigint, links bigint, root bigint"), "links")
    labels = components(links.where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v")), "labels")
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    classes = unique.select("digest", "id", "copies").join(counted, "id", "left").join(labels, "id", "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    out = packed.select("id", "digest").join(classes, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias("vec_id"), F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
