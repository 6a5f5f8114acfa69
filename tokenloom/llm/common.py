"""Helpers shared by the operators: intermediate tables, batches of bytes, components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path

BATCH_BYTES = 4 << 20
BATCH_ROWS = 1000
MMAP_THRESHOLD = -3  # of the C library's mallopt
MEMO_ENTRIES = 1 << 18
BROADCAST_IDS = 1_000_000


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again: cuts lineage, survives lost executors."""
    return settled(df, name)[0]


def settled(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    remove_path(spark, path)


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by rows and bytes, so that batches of long texts stay small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator reads, under its own names."""
    return df.select(*(df[old].alias(new) for new, old in columns.items()))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def lean() -> None:
    """Let large arrays go back to the system when they are freed, those of Arrow too."""
    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").mallopt(MMAP_THRESHOLD, 1 << 19)


def trim() -> None:
    """Give freed memory back, so that idle Python workers stay small."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(fn: Callable):
    """An Arrow function over batches, or over one group, that trims when it is done."""
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        yield from fn(rows)
        trim()

    def group(table: pa.Table) -> pa.Table:
        lean()
        out = fn(table)
        trim()
        return out

    return lambda rows: group(rows) if isinstance(rows, pa.Table) else batches(rows)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores at its end until no column in ``taken`` is called so, in either case of letters."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch], memo: dict | None = None):
    """An Arrow function that maps one batch at a time; a ``memo`` is emptied at the end, before memory is given back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
        if memo is not None:
            memo.clear()
        trim()
    return run


class Memo(dict):
    """A bounded cache: forgets everything when full."""

    def __init__(self, make: Callable, limit: int = MEMO_ENTRIES) -> None:
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def having(df: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among ``ids`` (one column of its name).

    The ids are written and counted; up to ``BROADCAST_IDS`` are broadcast, so that the rows stay where they are, more are joined.
    """
    wanted = settle(ids.distinct(), name)
    few = wanted.count() <= BROADCAST_IDS
    return df.join(F.broadcast(wanted) if few else wanted, key, "left_semi")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """As ``linked_components``, without the path."""
    return linked_components(edges, name)[0]


def linked_components(edges: DataFrame, name: str = "components") -> tuple[DataFrame, str]:
    """``(u, v)`` links -> ``(id, component)``, the smallest id reachable, for every linked id, and the path of the table.

    Ids may be of any type that can be ordered.

    Alternating large-star and small-star steps: a step moves every neighbour to the smallest
    one, so long chains halve and no step holds a vertex's neighbours in one place. Minima are
    combined before the shuffle; the join back may be split where a hub is hot.
    """
    spark = edges.sparkSession
    path = None

    def star(pairs: DataFrame, small: bool) -> DataFrame:
        if small:
            own = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        else:
            own = pairs.select(F.explode(F.array(
                F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        low = own.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        joined = own.join(low, "u")
        if small:
            moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                low.select("u", F.col("m").alias("v")))
        else:
            moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.where("u <> v").distinct()

    current, path = settled(edges.select("u", "v").where("u <> v").distinct(), name)
    state = _state(current)
    while True:
        following, next_path = settled(star(star(current, False), True), name)
        drop(spark, path)
        current, path = following, next_path
        new_state = _state(current)
        if new_state == state:
            break
        state = new_state
    star_edges = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return star_edges.union(star_edges.select(F.col("component").alias("id"), "component").distinct()), path
