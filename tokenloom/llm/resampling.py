"""Importance resampling towards a target corpus over hashed n-gram buckets.

Two passes over the texts. The first counts bucket occurrences, the second scores documents by the mean
log-ratio ("gain") of their features' buckets and adds seeded Gumbel noise, so that the highest scores are
a draw without replacement in proportion to the importance weights.

Within a task the n-grams of a batch are interned in an open-addressed table of NumPy arrays: the xxhash64 of
an n-gram is its key, linear probing resolves clashes, and a slot is an n-gram's own only when the bytes agree
too. A slot stores bucket and count, so a bucket is computed once per distinct n-gram, and each occurrence
keeps its slot's number, through which gains are gathered.

Only bucket totals (as many as buckets) and the counts per score value (scores are whole numbers of bounded
size) come to the driver. Ranks are counted within a score value; nothing is sorted in one task.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, renamed, settle, tidy

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
SLICE = 1 << 20  # bytes of a text cut into words at a time
CHUNK = 1 << 17  # occurrences interned at a time

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def word_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text, ASCII letters lowered, in lists of about ``SLICE`` bytes; signs below 128 part words."""
    data = (text or b"").translate(_WORDS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        if words := data[at:end].split(b" "):
            yield [w for w in words if w]
        at = end


def features(text: bytes | None, longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """``(words, features)`` by slice: all runs of 1 to ``longest`` words, joined by a space."""
    before: list[bytes] = []
    for words in word_lists(text):
        runs = list(words)
        if longest > 1:
            line = before + words
            for n in range(2, longest + 1):
                first = max(0, len(before) - n + 1)
                runs += [b" ".join(line[i:i + n]) for i in range(first, len(line) - n + 1)]
            before = line[len(line) - longest + 1:] if len(line) >= longest - 1 else line
        yield len(words), runs


class NgramTable:
    """Interned n-grams of one batch: ``slot`` of each occurrence, ``bucket`` and ``count`` of each slot."""

    def __init__(self, grams: list[bytes], buckets: int, key=xxhash.xxh64_intdigest) -> None:
        n = len(grams)
        size = 1 << max(4, (2 * n).bit_length())
        items = np.empty(n, object)
        items[:] = grams
        keys = np.fromiter(map(key, grams), np.uint64, n)
        owner = np.full(size, -1, np.int64)  # the occurrence that holds a slot
        at = (keys & np.uint64(size - 1)).astype(np.int64)
        self.slot = np.zeros(n, np.int64)
        open_ = np.arange(n)
        while len(open_):
            place = at[open_]
            free = owner[place] < 0
            owner[place[free]] = open_[free]  # of several claims one stays
            held = owner[place]
            same = keys[held] == keys[open_]
            hits = np.flatnonzero(same)
            same[hits] = items[held[hits]] == items[open_[hits]]
            self.slot[open_[same]] = place[same]
            open_ = open_[~same]
            at[open_] = (at[open_] + 1) & (size - 1)
        used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        self.bucket[used] = [zlib.crc32(g) % buckets for g in items[owner[used]]]

    def bucket_counts(self, buckets: int) -> np.ndarray:
        return np.bincount(self.bucket, self.count, minlength=buckets).astype(np.int64)

    def gather(self, gains: np.ndarray) -> np.ndarray:
        """The gain of each occurrence."""
        return gains[self.bucket][self.slot]


def _chunks(texts: list[bytes | None], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """``(text number of each feature, words by text, features)``, about ``CHUNK`` features at a time."""
    def packed():
        out = np.repeat(rows, sizes), np.bincount(rows, counts, minlength=len(texts)).astype(np.int64), grams
        return out

    rows, sizes, counts, grams = [], [], [], []
    for i, text in enumerate(texts):
        for n_words, runs in features(text, longest):
            rows.append(i)
            sizes.append(len(runs))
            counts.append(n_words)
            grams += runs
            if len(grams) >= CHUNK:
                yield packed()
                rows, sizes, counts, grams = [], [], [], []
    if rows:
        yield packed()


def bucket_totals(texts: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of all features by bucket, over all rows; each task sends one row."""
    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, grams in _chunks(as_bytes(batch.column("text")), longest):
                total += NgramTable(grams, buckets).bucket_counts(buckets)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["totals"])

    parts = renamed(texts, text=text_col).mapInArrow(tidy(run), "totals array<bigint>")
    rows = parts.select(F.posexplode("totals").alias("bucket", "n")).where("n > 0") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log-ratio of smoothed shares."""
    more_s, more_t = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1) * more_s / ((s + 1) * more_t)))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: np.ndarray, longest: int = 1, seed: int = SEED, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every row."""
    bounded_batches(docs.sparkSession)
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), as_bytes(batch.column("text"))
            words, size, total = (np.zeros(len(texts), np.int64) for _ in range(3))
            for row, counts, grams in _chunks(texts, longest):
                words += counts
                size += np.bincount(row, minlength=len(texts))
                gained = NgramTable(grams, buckets).gather(gains)
                # A chunk's sum stays below 2**17 * 10**5, so doubles hold it.
                total += np.bincount(row, gained, minlength=len(texts)).astype(np.int64)
            weight = np.where(size > 0, total // np.maximum(size, 1), 0)
            score = weight + np.array([noise(i, seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, pa.int64()) for c in (words, size, weight, score))],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = renamed(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    return rows.mapInArrow(tidy(run), "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Add ``rank`` to the drawn rows: the highest scores among rows of ``least_words``, ties to the smaller id.

    Equal rows take following ranks. Rows below the last drawn score stay where they are; the others are counted by
    score and id before they are ordered, so that a repeated row is one, and each score value is ordered by itself.
    """
    spark = scored.sparkSession
    able = F.col("n_words") >= least_words
    counts = {r.score: r["count"] for r in scored.where(able).groupBy("score").count().collect()}  # bounded score values
    wanted = percent * sum(counts.values()) // 100
    starts, before = [], 0
    for value in sorted(counts, reverse=True):
        if before >= wanted:
            break
        starts.append((value, before))
        before += counts[value]
    columns = [*scored.columns, "rank"]
    if not starts:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    high = able & (F.col("score") >= starts[-1][0])
    keys = scored.columns
    order = W.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), *[c for c in keys if c != "doc_id"])
    above = F.coalesce(F.sum("_n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    places = spark.createDataFrame(starts, "score bigint, _before bigint")
    drawn = scored.where(high).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_above", above).join(F.broadcast(places), "score") \
        .withColumn("rank", F.explode(F.expr("sequence(_before + _above + 1, _before + _above + _n)"))) \
        .withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.where(~high).withColumn("rank", F.lit(None).cast("bigint"))
    return rest.select(columns).union(drawn.select(columns))


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``.

    Null, empty and wordless texts have no features, weigh 0 and are never drawn (with ``least_words`` above 0).
    Rows without an id share one noise, as if their id were empty, and lose ties. Repeated rows count each time. An empty
    ``docs`` gives no rows; with an empty target all gains come from the source alone. Other columns are ignored.
    """
    gains = bucket_gains(bucket_totals(docs, text_col, longest, buckets), bucket_totals(target, target_col, longest, buckets))
    return draw(settle(weigh(docs, gains, longest, seed, id_col, text_col), "weighed"), percent, least_words)
