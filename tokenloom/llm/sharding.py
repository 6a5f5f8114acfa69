"""Indivisible groups in shards of nearly equal bytes: best-fit decreasing over a balanced tree.

Groups are sorted by size and each enters the shard with the least room that still holds it; a treap
over (room, shard) finds it. ``pack_groups`` opens as few shards of a fixed capacity as it can.
For a given number of shards, the smallest capacity that needs no more is found by bisection.

Groups of equal texts stay together unless one is larger than an equal share: the law ``bytes`` forces such a
group apart, by a hash of the id. Few large groups that fit a shard can leave the shards as uneven as they
are. Groups below 1 / ``PARTS`` of a shard are bundled by a hash of their text, so what is packed on the
driver is bounded by the number of shards, not by the table.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import renamed, settle

PARTS = 512
BUNDLES = 16_384
CELL_ROWS = 100_000
MAX_SHARDS = 1024


class RoomTree:
    """A treap of (room, shard): insert, and removal of the smallest room of at least a size."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]
        self.random = random.Random(5)

    def _split(self, node: list | None, key: tuple) -> tuple[list | None, list | None]:
        """Nodes below ``key`` and the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return b if a is None else a
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, room: int, shard: int) -> None:
        left, right = self._split(self.root, (room, shard))
        self.root = self._merge(self._merge(left, [(room, shard), self.random.random(), None, None]), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest ``(room, shard)`` that holds ``size``."""
        left, right = self._split(self.root, (size, -1))
        node, parent = right, None
        if node is None:
            self.root = left
            return None
        while node[2] is not None:
            node, parent = node[2], node
        if parent is None:
            right = node[3]
        else:
            parent[2] = node[3]
        self.root = self._merge(left, right)
        return node[0]


def pack_groups(sizes: dict, capacity: int) -> dict:
    """Shard number by group, best-fit decreasing; ties go by key. A group over the capacity has its own shard."""
    tree, shards, made = RoomTree(), {}, 0
    for key, size in sorted(sizes.items(), key=lambda x: (-x[1], str(x[0]))):
        found = tree.take(size)
        if found is None:
            found, made = (max(capacity, size), made), made + 1
        room, shard = found
        tree.add(room - size, shard)
        shards[key] = shard
    return shards


def even_shards(sizes: dict, n: int) -> dict:
    """At most ``n`` shards of the smallest capacity that best-fit decreasing needs for them.

    A group larger than an equal share has a shard of its own, and the rest is levelled over the others.
    """
    if not sizes:
        return {}
    largest = max(sizes, key=lambda k: (sizes[k], str(k)))
    if n > 1 and sizes[largest] * n > sum(sizes.values()):
        rest = even_shards({k: s for k, s in sizes.items() if k != largest}, n - 1)
        return {**rest, largest: n - 1}
    low = max(max(sizes.values()), -(-sum(sizes.values()) // n))
    high, best = low + max(sizes.values()), None
    while best is None or low < high:
        middle = (low + high) // 2 if best is not None else high
        shards = pack_groups(sizes, middle)
        if max(shards.values()) < n:
            best, high = shards, middle
        elif best is None:
            high *= 2
        else:
            low = middle + 1
    return best


def shard_by_bytes(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``docs``.

    The size is the text's UTF-8 bytes plus 1; a null text has none and is a group apart from
    the empty one. ``slot`` numbers a shard's rows from 0 by id within hash cells. The law is ``bytes``, so no
    shard is named for growth. Repeated rows count as often as they occur; an empty table gives none.
    """
    if not 0 < n <= MAX_SHARDS:
        raise ValueError(f"1 to {MAX_SHARDS} shards")
    text = F.col("text")
    rows = renamed(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.unhex(F.concat(F.md5(F.coalesce(text, F.lit("")).cast("binary")), F.when(text.isNull(), "01").otherwise("00"))).alias("digest"))
    groups = settle(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "groups")
    total, n_rows = groups.agg(F.sum("bytes"), F.sum("rows")).first()
    if not total:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    limit = max(1, total // (n * PARTS))
    # At most n * PARTS groups are larger than the limit.
    large = groups.where(F.col("bytes") > limit).select(
        "digest", F.ceil(F.col("bytes") / F.lit(max(1, -(-total // n)))).cast("int").alias("pieces"))
    part = F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).otherwise(0).cast("int")
    bundle = F.pmod(F.xxhash64("digest"), F.lit(BUNDLES))
    unit = F.when(F.col("pieces").isNull(), F.concat(F.lit("b"), bundle)).otherwise(F.concat(F.hex("digest"), F.lit(":"), part))
    placed = rows.join(F.broadcast(large), "digest", "left").withColumn("unit", unit)
    sizes = {r.unit: r.bytes for r in placed.groupBy("unit").agg(F.sum("size").alias("bytes")).collect()}
    shards = docs.sparkSession.createDataFrame(list(even_shards(sizes, n).items()), "unit string, shard int")
    cells = max(1, -(-n_rows // CELL_ROWS))
    cell = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(cells))
    sharded = placed.join(F.broadcast(shards), "unit").select("doc_id", "size", "text_crc32", "shard", cell.alias("cell"))
    counts: dict[int, int] = {}
    starts = []
    for r in sharded.groupBy("shard", "cell").count().orderBy("shard", "cell").collect():
        starts.append((r.shard, r.cell, counts.get(r.shard, 0)))
        counts[r.shard] = counts.get(r.shard, 0) + r["count"]
    first = docs.sparkSession.createDataFrame(starts, "shard int, cell bigint, first bigint")
    ranked = sharded.withColumn("rank", F.expr("row_number() OVER (PARTITION BY shard, cell ORDER BY doc_id, text_crc32)"))
    return ranked.join(F.broadcast(first), ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
