"""Order as data: positions, reproducible shuffles, exact splits, top-k."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import DEV_RATIO, TEST_FRACTION
from ..functions.hashing import PREFIX_DIGITS, seeded_hash
from ..session import written

EXAMPLE_KEYS = ("file", "doc_id", "ex_idx")

# A 64-bit key is cut into 26 + 26 + 12 bits: ranges of 4,096 keys, and groups of 2**26
# ranges. However large or sparse a file is, a window sees the rows of 4,096 keys, or at most
# 2**26 sums.
RANGE_BITS, GROUP_BITS = 12, 26

ORDER_BLOCKS = 65_536  # rows of the table that deals ordered rows to partitions


def _before(value: Column | str, within: Sequence[str], order: Sequence) -> Column:
    """The sum of ``value`` over the earlier rows."""
    window = W.partitionBy(*within).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0)).cast("bigint")


def _ranged(df: DataFrame, file: str, key: str) -> DataFrame:
    """Add ``_file``, which orders like the file and is never null, and ``_range``, the key range of a row.

    For nullable grouping columns the joins below would add their own null filters to each branch, and no branch
    could reuse another's shuffle. A null file comes first.
    """
    return df.withColumn("_file", F.coalesce(F.concat(F.lit("/"), file), F.lit(""))).withColumn(
        "_range", F.coalesce(F.shiftright(F.col(key).cast("bigint"), RANGE_BITS), F.lit(0))
    )


def _range_starts(ranged: DataFrame, value: Column) -> DataFrame:
    """``(_file, _range, n, start)``: what lies in each key range and before it in the file.

    The rows are read once, into one sum per range; the rest works on those sums.
    """
    sums = ranged.groupBy("_file", "_range").agg(F.sum(value).cast("bigint").alias("n"))
    sums = sums.withColumn("n", F.coalesce("n", F.lit(0)))
    sums = sums.withColumn("_group", F.shiftright("_range", GROUP_BITS))
    groups = sums.groupBy("_file", "_group").agg(F.sum("n").alias("m")).select(
        "_file", "_group", _before("m", ["_file"], ["_group"]).alias("base"))
    inner = sums.withColumn("start", _before("n", ["_file", "_group"], ["_range"]))
    return inner.join(groups, ["_file", "_group"]).select(
        "_file", "_range", "n", (F.col("base") + F.col("start")).alias("start")
    )


def _overall_starts(ranged: DataFrame, file_order: Callable[[str], Column]) -> DataFrame:
    """``(_file, _range, n, start, total)`` over all files; one row per file is ordered."""
    ranges = _range_starts(ranged, F.lit(1))
    files = ranges.groupBy("_file").agg(F.sum("n").alias("m")).withColumn(
        "_name", F.when(F.col("_file") != "", F.substr("_file", F.lit(2))))
    bases = files.select(
        "_file",
        _before("m", [], [file_order("_name"), "_file"]).alias("base"),
        F.sum("m").over(W.partitionBy()).alias("total"),
    )
    return ranges.join(bases, "_file").select(
        "_file", "_range", "n", (F.col("base") + F.col("start")).alias("start"), "total"
    )


def join_places(df: DataFrame, places: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns that ``places`` holds for the keys, which identify a row; null keys are equal.

    The rows of ``df`` are shuffled once, by their keys.
    """
    mine = {k: f"_{k}_of_place" for k in keys}
    other = places.withColumnsRenamed(mine)
    same = reduce(and_, (df[k].eqNullSafe(other[mine[k]]) for k in keys))
    return df.join(other, same).drop(*mine.values())


def with_offsets(df: DataFrame, file: str, key: str, value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the file with a smaller key.

    ``key`` is a bigint, unique within the file. Keys and values alone are written once and added up, first per key
    range, so a file that holds most of the rows still spreads over many tasks; the rows
    themselves are shuffled once, to meet their offsets.
    """
    narrow = written(df.select(file, key, value.cast("bigint").alias("_value")), "offsets")
    ranged = _ranged(narrow, file, key)
    within = ranged.withColumn(out, _before("_value", ["_file", "_range"], [key]))
    starts = _range_starts(ranged, F.col("_value")).select("_file", "_range", "start")
    places = within.join(starts, ["_file", "_range"]).select(file, key, (F.col(out) + F.col("start")).alias(out))
    return join_places(df, places, [file, key])


def file_positions(examples: DataFrame, keys: Sequence[str] = EXAMPLE_KEYS,
                   file_order: Callable[[str], Column] = F.col) -> DataFrame:
    """Add ``pos``, 0-based, in file, document and example order."""
    file, doc, index = keys
    ranged = _ranged(examples, file, doc)
    rank = F.row_number().over(W.partitionBy("_file", "_range").orderBy(doc, index))
    starts = _overall_starts(ranged, file_order).select("_file", "_range", "start")
    return (
        ranged.withColumn("rank", rank).join(starts, ["_file", "_range"])
        .withColumn("pos", F.col("start") + F.col("rank") - 1).drop("_file", "_range", "start", "rank")
    )


def file_parts(df: DataFrame, keys: Sequence[str], ids: str = "ids", parts: int | None = None) -> DataFrame:
    """Deal the rows to numbered partitions that follow (file, document); ``keys`` begin with these two.

    A row's partition is looked up in the running sum of ids over at most ``ORDER_BLOCKS`` blocks of keys, so nothing
    is sampled and the rows are shuffled once. The keys of a block are as many as that bound asks for; one
    document always stays whole. Inside a partition the rows are in any order.
    """
    file, doc = keys[:2]
    parts = parts or _partitions(df)
    key = F.coalesce(F.col(doc).cast("bigint"), F.lit(0))
    placed = _ranged(df, file, doc).drop("_range").withColumn("_key", key)
    narrow = written(placed.select("_file", "_key", (F.coalesce(F.size(ids), F.lit(0)) + 1).alias("n")), "weights")
    shifts = range(0, 64, 4)
    numbers = narrow.agg(*[
        F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64("_file", F.shiftright("_key", s)))).alias(f"s{s}")
        for s in shifts]).first()
    shift = next((s for s in shifts if numbers[f"s{s}"] <= ORDER_BLOCKS // 2), shifts[-1])
    sums = written(narrow.groupBy("_file", F.shiftright("_key", shift).alias("_block")).agg(F.sum("n").alias("n")), "blocks")
    before, total = _before("n", [], ["_file", "_block"]), F.sum("n").over(W.partitionBy())
    starts = sums.select("_file", "_block", before.alias("before"), total.alias("total"))
    parted = starts.select("_file", "_block", F.expr(f"cast(before * {parts} div total as int)").alias("_part"))
    few = sums.count() <= ORDER_BLOCKS  # more only where there are more files than that
    placed = placed.withColumn("_block", F.shiftright("_key", shift)).drop("_key")
    joined = placed.join(F.broadcast(parted) if few else parted, ["_file", "_block"])
    return joined.repartitionById(parts, "_part").drop("_file", "_block", "_part")


def seeded_parts(df: DataFrame, keys: Sequence[str] = EXAMPLE_KEYS, seed: int = 0,
                 parts: int | None = None) -> DataFrame:
    """Deal the rows to numbered partitions that follow the order of ``shuffle_rows``; adds ``shuffle_key``.

    Hash prefixes are spread evenly, so nothing is counted or sampled and the rows are shuffled once. Sorted by
    ``(shuffle_key, *keys)`` inside the partitions they are in that order.
    """
    parts = min(parts or _partitions(df), 16 ** PREFIX_DIGITS)
    hashed = df.withColumn("shuffle_key", seeded_hash(seed, *keys))
    prefix = F.conv(F.substring("shuffle_key", 1, PREFIX_DIGITS), 16, 10).cast("bigint")
    part = F.shiftright(prefix * parts, 4 * PREFIX_DIGITS).cast("int")
    return hashed.withColumn("_part", part).repartitionById(parts, "_part").drop("_part")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _histogram(hashes: DataFrame) -> DataFrame:
    """``(prefix, n, before, total)`` over at most 16**4 hash prefixes."""
    counts = hashes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "prefix", "n", _before("n", [], ["prefix"]).alias("before"),
        F.sum("n").over(W.partitionBy()).alias("total"),
    )


def _hash_positions(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """Add ``pos`` in seeded order, and ``total``."""
    hashed = df.withColumn("shuffle_key", seeded_hash(seed, *keys))
    hashed = hashed.withColumn("prefix", F.substring("shuffle_key", 1, PREFIX_DIGITS))
    starts = _histogram(hashed.select("prefix")).select("prefix", "before", "total")
    rank = F.row_number().over(W.partitionBy("prefix").orderBy("shuffle_key", *keys))
    return (
        hashed.withColumn("rank", rank).join(F.broadcast(starts), "prefix")
        .withColumn("pos", F.col("before") + F.col("rank") - 1)
        .drop("prefix", "rank", "before", "shuffle_key")
    )


def shuffle_rows(df: DataFrame, keys: Sequence[str] = EXAMPLE_KEYS, seed: int = 0) -> DataFrame:
    """Add ``pos``, the place of each row in an order fixed by the seed.

    The keys identify a row. Rows are ranked within their hash prefix, in parallel; the
    counts per prefix, at most 65,536, are broadcast.
    """
    return _hash_positions(df, keys, seed).drop("total")


def shuffle_files(examples: DataFrame, keys: Sequence[str] = EXAMPLE_KEYS,
                  seed: int = 0) -> DataFrame:
    """Add ``pos``: files in an order fixed by the seed, rows in their own order inside."""
    return file_positions(examples, keys, lambda name: seeded_hash(seed, name))


def _cut_at(df: DataFrame, narrow: DataFrame, key: Column, buckets: DataFrame, bucket: Sequence[str],
            names: tuple[str, str]) -> DataFrame:
    """Label rows up to the ``wanted``-th one by comparing keys; the rows stay where they are.

    ``buckets(*bucket, n, before, wanted)`` tells in which bucket the cut falls, and only
    the keys of that bucket are ranked. ``narrow`` holds the keys and buckets of all rows.
    """
    edge = buckets.filter("before < wanted and wanted <= before + n").select(
        F.struct(*bucket, (F.col("wanted") - F.col("before")).alias("wanted"))).scalar()
    inside = narrow.filter(F.struct(*bucket) == F.struct(*[edge[b].alias(b) for b in bucket]))
    rank = F.row_number().over(W.partitionBy(*bucket).orderBy("k"))
    last = inside.select(*bucket, key.alias("k")).withColumn("rank", rank)
    limit = last.filter(F.col("rank") == edge["wanted"]).select("k").scalar()
    first, rest = names
    upto = F.coalesce(key <= limit, F.lit(False))
    return df.withColumn("split", F.when(upto, first).otherwise(rest))


def _hash_cut(df: DataFrame, keys: Sequence[str], seed: int, wanted: Callable[[Column], Column],
              names: tuple[str, str]) -> DataFrame:
    """Label the first ``wanted(n)`` rows of the seeded order; the keys are written once, to be counted and ranked."""
    hash_ = seeded_hash(seed, *keys)
    narrow = written(df.select(*keys), "keys").withColumn("_prefix", F.substring(hash_, 1, PREFIX_DIGITS))
    buckets = _histogram(narrow.select(F.col("_prefix").alias("prefix"))).select(
        F.col("prefix").alias("_prefix"), "n", "before",
        wanted(F.col("total")).cast("bigint").alias("wanted"))
    key = F.struct(hash_.alias("h"), *keys)
    return _cut_at(df, narrow, key, buckets, ["_prefix"], names)


def _head_cut(df: DataFrame, keys: Sequence[str], wanted: Callable[[Column], Column],
              names: tuple[str, str]) -> DataFrame:
    """Label the first ``wanted(n)`` rows in file order; the keys are written once, to be counted and ranked."""
    file, doc, _ = keys
    narrow = _ranged(written(df.select(*keys), "keys"), file, doc)
    buckets = _overall_starts(narrow, F.col).select(
        "_file", "_range", "n", F.col("start").alias("before"),
        wanted(F.col("total")).cast("bigint").alias("wanted"))
    return _cut_at(df, narrow, F.struct(*keys), buckets, ["_file", "_range"], names)


def _share(ratio: float) -> Callable[[Column], Column]:
    """``round(n * ratio)``, halves to even."""
    return lambda n: F.rint(n * F.lit(float(ratio)))


def split_head(examples: DataFrame, dev_ratio: float = DEV_RATIO, shuffle: bool = False,
               seed: int = 0, keys: Sequence[str] = EXAMPLE_KEYS) -> DataFrame:
    """Add ``split``: exactly ``round(n * dev_ratio)`` leading rows are dev, the rest train.

    Halves round to even. Rows lead in file order, or in the order of ``shuffle_rows``.
    """
    if shuffle:
        return _hash_cut(examples, keys, seed, _share(dev_ratio), ("dev", "train"))
    return _head_cut(examples, keys, _share(dev_ratio), ("dev", "train"))


def shuffle_and_split(examples: DataFrame, dev_ratio: float = DEV_RATIO, seed: int = 0,
                      keys: Sequence[str] = EXAMPLE_KEYS) -> DataFrame:
    """Add the ``pos`` of ``shuffle_rows`` and the ``split`` of ``split_head`` together."""
    placed = _hash_positions(examples, keys, seed)
    dev = F.col("pos") < _share(dev_ratio)(F.col("total"))
    return placed.withColumn("split", F.when(dev, "dev").otherwise("train")).drop("total")


def split_fraction(df: DataFrame, test_size: float = TEST_FRACTION, seed: int = 0,
                   keys: Sequence[str] = ("sent_id",)) -> DataFrame:
    """Add ``split``: ``ceil(n * test_size)`` random rows are test, the rest train."""
    def wanted(n: Column) -> Column:
        return F.ceil(n * F.lit(float(test_size)))

    return _hash_cut(df, keys, seed, wanted, ("test", "train"))


def top_k(df: DataFrame, group: Sequence[str], order: Sequence, k: int = 3) -> DataFrame:
    """The first ``k`` rows per group with their ``rank`` from 1.

    Spark drops rows beyond ``k`` before the shuffle as well as after it.
    """
    rank = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)
