"""Near-duplicate documents by MinHash, with odd sketches to check candidates.

Per text, a set of distinct word shingles is sampled by ``BANDS * ROWS`` MinHash functions.
Bands of ``ROWS`` samples are bucket keys. All samples are folded into a parity bitmap, the odd
sketch: a sample flips one bit, so the population count of the XOR of two sketches estimates
in how many samples two sets differ. Candidates whose estimate is far below the threshold are
dropped; the others are compared on full sets.

A bucket may hold very many texts, so its pairs are never listed:

1. Each bucket compares its texts with one hub, the text that shares most buckets. Links merge components.
2. In buckets that still hold several components, texts meet by an exact prefix filter. Shingles are ordered from
   the rarest; two sets that reach the threshold share one of the first few of each, how few following from both
   sizes. So a list of texts is kept per shingle and pair of size classes, and pages of one template, which differ
   in rare shingles, meet in none. Each list compares its texts with a hub of its own, and links merge components.
3. What still differs within a list is compared pair by pair, except for pairs within the list's largest component
   and pairs refuted before.

A class of equal sets is a node ``(smallest id, digest of the set)``, so different texts under one id stay apart, and
the smallest node of a component has its smallest id. Tables of the steps are removed when the next one is written.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Memo, as_bytes, bounded_batches, drop, fresh, having, linked_components, mix64, per_batch, renamed, settle, settled

ROWS = 5
BANDS = 38
SAMPLES = ROWS * BANDS
SKETCH_BITS = 512
MARGIN = 0.2
BLOCK = 2048
SIZE_CLASS = 1.05  # ratio between the bounds of a size class

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)


def word_hashes(text: bytes, memo: Memo) -> np.ndarray:
    """Hashes of the words: ASCII letters lowered, split at ASCII white space."""
    words = text.lower().split()
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def shingle_set(text: bytes | None, width: int, memo: Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    words = word_hashes(text or b"", memo)
    if not len(words):
        return words
    acc = np.full(max(1, len(words) - width + 1), len(words[:width]), np.uint64)
    for j in range(min(width, len(words))):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + words[j:j + len(acc)])
    return np.unique(acc)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    low = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(high), BLOCK):
        part = high[i:i + BLOCK]
        np.minimum(low, (_A[:, None] * part + _B[:, None]).min(axis=1), out=low)
    return low


def band_keys(samples: np.ndarray) -> np.ndarray:
    acc = np.arange(BANDS, dtype=np.uint64)
    for column in samples.reshape(BANDS, ROWS).T:
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + column)
    return acc.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples as 64-bit words."""
    bits = mix64(samples.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)))
    parity = np.bincount((bits % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def sketch_limit(percent: int) -> int:
    """The largest XOR count that a pair may have: the estimate is MARGIN below the threshold."""
    differing = 2 * SAMPLES * (1 - max(0.0, percent / 100 - MARGIN))
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-2 * differing / SKETCH_BITS)))


def _signatures(width: int):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])
    memo = Memo(lambda w: xxhash.xxh3_64_intdigest(w))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, digest, bands, sketch = [], [], [], []
        for text in as_bytes(batch.column("text")):
            shingles = shingle_set(text, width, memo)
            n.append(len(shingles))
            if len(shingles):
                samples = minhashes(shingles)
                digest.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                bands.append(band_keys(samples))
                sketch.append(odd_sketch(samples))
            else:
                digest.append(None)
                bands.append(None)
                sketch.append(None)
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))], schema=schema)
    return per_batch(run, memo)


def _sets(width: int):
    schema = pa.schema([("digest", pa.binary()), ("items", pa.list_(pa.int64()))])
    memo = Memo(lambda w: xxhash.xxh3_64_intdigest(w))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(text, width, memo) for text in as_bytes(batch.column("text"))]
        return pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
             pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], schema=schema)
    return per_batch(run, memo)


def _digests(width: int):
    """``(id, text_hash, digest)`` of the rows; a text without shingles has no digest."""
    memo = Memo(lambda w: xxhash.xxh3_64_intdigest(w))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(text, width, memo) for text in as_bytes(batch.column("text"))]
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("text_hash"), pa.array(digests, pa.binary())], names=["id", "text_hash", "digest"])
    return per_batch(run, memo)


def _differing(a: str, b: str) -> Column:
    words = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_BITS // 64)]
    return sum(words[1:], words[0])


class _Graph:
    """The links found so far, as components, and how pairs are verified."""

    def __init__(self, reps: DataFrame, sets: DataFrame, percent: int) -> None:
        self.spark = reps.sparkSession
        self.side, self.sets, self.percent = reps.select("node", "n", "sketch"), sets, percent
        self.links: list[DataFrame] = []
        self.labels: DataFrame | None = None
        self.path: str | None = None

    def verify(self, pairs: DataFrame) -> None:
        """Pairs ``(a, b)`` of nodes, tried once each: sizes, then sketches, then full sets. Links merge components."""
        own = self.side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        other = self.side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        likely, path = settled(pairs.join(own, "a").join(other, "b").where(
            (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
            & (_differing("sa", "sb") <= sketch_limit(self.percent))).select("a", "b"), "likely")
        wanted = likely.select(F.explode(F.array("a.digest", "b.digest")).alias("digest"))
        sets = having(self.sets, "digest", wanted, "compared")
        full = likely.join(sets.select(F.col("digest").alias("db"), F.col("items").alias("ib")), F.col("b.digest") == F.col("db")) \
            .join(sets.select(F.col("digest").alias("da"), F.col("items").alias("ia")), F.col("a.digest") == F.col("da"))
        common = F.size(F.array_intersect("ia", "ib"))
        links = settle(full.select("a", "b", common.alias("c"), (F.size("ia") + F.size("ib")).alias("s")).where(
            F.expr(f"c * 100L >= {self.percent}L * (s - c)")).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
        drop(self.spark, path)
        self.links.append(links)
        edges = links if self.labels is None else links.union(self.labels.select(F.col("id").alias("u"), F.col("component").alias("v")))
        old = self.path
        self.labels, self.path = linked_components(edges, "labels")
        if old:
            drop(self.spark, old)

    def labelled(self, rows: DataFrame) -> DataFrame:
        """Add ``label``, the component of ``node``."""
        found = self.labels.select(F.col("id").alias("node"), "component")
        return rows.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")


def _with_hubs(lists: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, hub)`` of every list: the text of the highest score."""
    return lists.groupBy(*keys).agg(F.max(F.struct("score", "node")).alias("top")).select(*keys, F.col("top.node").alias("hub"))


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(SIZE_CLASS)).cast("int")


def prefix_lists(texts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(token, low, high, class, at, node, n, score, label)``: texts ``(node, score, label)`` by their rarest shingles.

    Sets of sizes n and m that reach the threshold share at least ``percent (n + m) / (100 + percent)`` shingles, so, in one
    order for all, one of the first ``n - that + 1`` of the one and of the other. A text stands in a list for each
    shingle that may be needed for a partner of size class ``low`` or ``high``, the other of which is its own ``class``.
    ``at`` is the shingle's place in that order, from 0.
    """
    tokens = texts.join(sets, F.col("node.digest") == F.col("digest")).select(
        "node", "score", "label", F.size("items").cast("bigint").alias("n"), F.explode("items").alias("token"))
    seen = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    at = F.row_number().over(W.partitionBy("node").orderBy("df", "token")) - 1
    least, most = F.ceil(F.col("n") * percent / 100), F.floor(F.col("n") * 100 / percent)

    def length(partner: Column) -> Column:
        return F.col("n") - F.ceil(percent * (F.col("n") + partner) / (100 + percent)) + 1

    # A text's rows are sorted, not gathered; beyond the longest of its prefixes they are dropped.
    ranked = tokens.join(seen, "token").withColumn("at", at).where((F.col("df") > 1) & (F.col("at") < length(least)))
    per_class = ranked.withColumn("class", size_class(F.col("n"))).withColumn(
        "partner", F.explode(F.sequence(size_class(least) - 1, size_class(most) + 1)))
    # One below the class's bound, so that rounding in the logarithm loses no size.
    smallest = F.greatest(F.floor(F.pow(F.lit(SIZE_CLASS), F.col("partner"))) - 1, least)
    return per_class.where(F.col("at") < length(smallest)).select(
        "token", F.least("class", "partner").alias("low"), F.greatest("class", "partner").alias("high"), "class", "at", "node", "n",
        "score", "label")


def links_and_members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame | None]:
    """Signatures ``(id, n, digest, ...)`` and the components ``(id, component)`` of linked nodes."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = renamed(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    signed = settle(texts.mapInArrow(
        _signatures(width), "id bigint, n bigint, digest binary, bands array<bigint>, sketch array<bigint>"), "minhash")
    # A null id never stands for its group unless all ids are null.
    reps = settle(signed.where("n > 0 AND id IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("id"), F.first("n").alias("n"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).select(
        F.struct("id", "digest").alias("node"), "n", "bands", "sketch"), "reps")
    keyed = reps.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    members, members_path = settled(keyed.join(shared, "key"), "buckets")
    scores = members.groupBy("node").agg(F.sum((F.log2("texts") * 16).cast("bigint")).alias("score"))
    scored, scored_path = settled(members.join(scores, "node").select("key", "node", "score"), "scored")
    drop(spark, members_path)
    sets = settle(having(texts, "id", scored.select("node.id"), "candidates").mapInArrow(
        _sets(width), "digest binary, items array<bigint>").dropDuplicates(["digest"]), "sets")
    graph = _Graph(reps, sets, percent)

    hubs = _with_hubs(scored, ["key"])
    tried, tried_path = settled(scored.join(hubs, "key").where("node <> hub").select(
        *_ordered(F.col("node"), F.col("hub"))).distinct(), "tried")
    graph.verify(tried)

    # Texts that share a bucket with a text of another component, neither of them its hub.
    own, own_path = settled(graph.labelled(scored.join(hubs, "key").where("node <> hub")), "own")
    open_ = own.groupBy("key").agg(F.min("label").alias("lowest"), F.max("label").alias("highest")).where("lowest <> highest")
    left, left_path = settled(own.join(open_, "key", "left_semi").select("node", "score", "label").distinct(), "left")
    drop(spark, own_path)
    drop(spark, scored_path)
    keys = ["token", "low", "high"]
    entries, entries_path = settled(prefix_lists(left, sets, percent), "lists")
    several = entries.groupBy(*keys).agg(F.min("label").alias("lowest"), F.max("label").alias("highest")).where("lowest <> highest")
    lists, lists_path = settled(entries.join(several.select(*keys), keys, "left_semi"), "open-lists")
    drop(spark, entries_path)
    drop(spark, left_path)
    heads = _with_hubs(lists, keys)
    heads = heads.join(lists.select(*keys, F.col("node").alias("hub"), F.col("label").alias("head")), [*keys, "hub"])
    more, more_path = settled(lists.join(heads, keys).where("label <> head").select(
        *_ordered(F.col("node"), F.col("hub"))).distinct().join(tried, ["a", "b"], "left_anti"), "tried")
    graph.verify(more)

    # What is left: pairs of a list in two components, one of them not the list's largest.
    rest, rest_path = settled(graph.labelled(lists.drop("label")), "rest")
    by_label = rest.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("texts"))
    major = by_label.groupBy(*keys).agg(F.max_by("label", F.struct("texts", "label")).alias("major"), F.count(F.lit(1)).alias("labels")) \
        .where("labels > 1").select(*keys, "major")
    marked = rest.join(major, keys)
    minor = marked.where("label <> major").select(*keys, *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "class", "at", "label")))
    # The two are of the classes ``low`` and ``high``, and a first common shingle at these places leaves room for as many
    # as their own sizes need; of two minor ones the smaller node comes first.
    needed = F.ceil(percent * (F.col("n") + F.col("n_a")) / (100 + percent))
    met = minor.join(marked, keys).where(
        (F.col("label") != F.col("label_a")) & (F.col("class") + F.col("class_a") == F.col("low") + F.col("high"))
        & (F.least("n", "n_a") * 100 >= F.greatest("n", "n_a") * percent)
        & (F.least(F.col("n") - F.col("at"), F.col("n_a") - F.col("at_a")) >= needed)
        & ((F.col("label") == F.col("major")) | (F.col("node_a") < F.col("node"))))
    last, last_path = settled(met.select(*_ordered(F.col("node"), F.col("node_a"))).distinct()
                              .join(tried.union(more), ["a", "b"], "left_anti"), "tried")
    graph.verify(last)
    for path in (tried_path, more_path, last_path, lists_path, rest_path):
        drop(spark, path)
    return signed, graph.labels


def _classes(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Signatures, and ``(digest, component)`` of each class of equal sets, a component being its smallest node."""
    signed, labels = links_and_members(docs, id_col, text_col, width, percent)
    nodes = signed.where("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).select(
        F.struct("id", "digest").alias("node"))
    named = nodes.join(labels.select(F.col("id").alias("node"), "component"), "node", "left")
    return signed.select("id", "n", "digest"), named.select("node.digest", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Two texts are linked when ``100 * intersection >= percent * union`` of their shingle sets.
    ``component_id`` is the smallest id reachable; ``kept`` tells whether it is the row's own.
    Null, empty and blank texts have no shingles, form their own component and are kept. Equal
    sets are one class and never expanded to pairs. Repeated rows share their id and so their
    component. Different texts under one id are linked and labelled by themselves. A
    row without an id takes part only as a copy: it gets the component of its set's class, or
    null, and is kept only where there is none. Other columns are ignored; an empty table gives none.
    """
    rows, classes = _classes(docs, id_col, text_col, width, percent)
    out = rows.join(classes.select("digest", F.col("component.id").alias("component")), "digest", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one of each near-duplicate group left; all columns stay.

    Of rows with one id and one text, or texts of one group, one stays; different texts under one id that are in no
    group together all stay. Rows without an id stay.
    """
    kept_id, kept_hash, hash_col = (fresh(n, docs.columns) for n in ("_kept_id", "_kept_hash", "_text_hash"))
    rows, classes = _classes(docs, id_col, text_col, width, percent)
    heads = classes.where(F.col("component.digest") == F.col("digest")).select("digest", F.col("component.id").alias("head"))
    found = rows.where("id IS NOT NULL").join(heads, "digest", "left")
    stays = F.col("digest").isNull() | F.coalesce(F.col("id") == F.col("head"), F.lit(False))
    ids = settle(found.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.max(stays).alias("stays")).where("stays"), "kept")
    key = docs[id_col].cast("bigint")
    single = docs.join(ids.where("rows = 1").select(F.col("id").alias(kept_id)), key == F.col(kept_id), "left_semi")
    if ids.where("rows > 1").isEmpty():
        return single.union(docs.where(key.isNull()))
    often = ids.where("rows > 1").select(F.col("id").alias(kept_id))
    # An id with several rows: one row for each of its classes that stays, found by the hash of the text.
    repeated = docs.join(often, key == F.col(kept_id), "left_semi")
    text_hash = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    hashed = repeated.select(key.alias("id"), F.col(text_col).alias("text"), text_hash.alias("text_hash")) \
        .dropDuplicates(["id", "text_hash"]).mapInArrow(_digests(width), "id bigint, text_hash string, digest binary")
    chosen = hashed.join(heads, "digest", "left").where(stays).groupBy("id", "digest").agg(F.min("text_hash").alias(kept_hash)) \
        .select(F.col("id").alias(kept_id), kept_hash)
    matching = repeated.join(chosen, (key == F.col(kept_id)) & (text_hash == F.col(kept_hash)), "left_semi")
    one = matching.withColumn(hash_col, text_hash).dropDuplicates([id_col, hash_col]).drop(hash_col)
    return single.union(one).union(docs.where(key.isNull()))
