"""Cutting token lists into training examples of bounded length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EOS_ID
from ..functions.columns import bounds_from_ends, cut, fold_gathering, let, positions_where
from .ordering import with_offsets

_SPANS = "array<struct<start:int,len:int>>"
_OPEN = "struct<start:int,len:int>"


def _segments(ids: Column, eos: int) -> Column:
    """Bounds of the segments that end in ``eos``, and of the tail after the last one."""
    stops = F.transform(positions_where(ids, lambda x: x == eos), lambda p: p + 1)
    return bounds_from_ends(F.concat(stops, F.array(F.size(ids))))


def _packed(ids: Column, trim: int, eos: int) -> Column:
    """Bounds of the examples that greedy packing makes of one document.

    Only bounds are folded; the ids are cut once, afterwards. The tail follows the same
    rule as the other segments, and what is open at the end is one more example.
    """

    def spans(*items: Column) -> Column:
        return F.array(*items).cast(_SPANS)

    def span(start: Column, length: Column) -> Column:
        return F.struct(start.alias("start"), length.alias("len"))

    def closing(open_: Column) -> Column:
        return F.when(open_["len"] > 0, spans(span(open_["start"], open_["len"]))).otherwise(spans())

    def step(open_: Column, seg: Column) -> Column:
        too_long, fits = seg["len"] > trim, open_["len"] + seg["len"] <= trim
        ready = F.when(too_long, F.concat(closing(open_), spans(span(seg["start"], F.lit(trim))))) \
            .when(fits, spans()).otherwise(closing(open_))
        start = F.when(fits & (open_["len"] > 0), open_["start"]).otherwise(seg["start"])
        length = F.when(too_long, 0).when(fits, open_["len"] + seg["len"]).otherwise(seg["len"])
        return F.struct(span(start, length).alias("state"), ready.alias("new"))

    folded = fold_gathering(_segments(ids, eos), span(F.lit(0), F.lit(0)), step, _OPEN, _SPANS)
    return let(folded, lambda f: F.concat(f["gathered"], closing(f["state"])))


def _exploded(df: DataFrame, lists: Column, index: str, ids: str) -> DataFrame:
    others = [c for c in df.columns if c != ids]
    return df.select(*others, F.posexplode(lists).alias(index, ids))


def split_at_eos(df: DataFrame, eos: int = EOS_ID, ids: str = "ids") -> DataFrame:
    """One row per segment, ``seg_idx`` in order; the tail segment may be empty."""
    return _exploded(df, cut(F.col(ids), lambda v: _segments(v, eos)), "seg_idx", ids)


def pack_trim(df: DataFrame, trim: int, eos: int = EOS_ID, ids: str = "ids") -> DataFrame:
    """``examples(..., ex_idx, ids)``: whole sentences, greedily, up to ``trim`` ids each.

    A sentence longer than ``trim`` becomes an example of its own and loses the rest.
    Runs inside each row: no shuffle, no Python.
    """
    _check_length("trim", trim)
    return _exploded(df, cut(F.col(ids), lambda v: _packed(v, trim, eos)), "ex_idx", ids)


def count_packed(ids: Column, trim: int, eos: int = EOS_ID) -> Column:
    """How many examples ``pack_trim`` makes of a document."""
    return F.size(let(ids, lambda v: _packed(v, trim, eos)))


def chunk_block(df: DataFrame, block: int, file: str = "file", key: str = "doc_id",
                ids: str = "ids") -> DataFrame:
    """``examples(file, chunk_idx, ids)``: the lists of a file joined and cut every ``block`` ids.

    Chunks never cross files and the last one of a file may be short. A chunk that lies
    inside one list is final at once; only the ragged ends, at most one list of fewer
    than ``block`` ids per side, are shuffled to their neighbours.
    """
    _check_length("block", block)
    placed = with_offsets(df.select(file, key, ids), file, key, F.size(ids), "at")
    length = F.lit(block).cast("bigint")

    def parts(v: Column, at: Column) -> Column:
        def one(chunk: Column) -> Column:
            start = F.greatest(chunk * length - at, F.lit(0).cast("bigint"))
            stop = F.least((chunk + 1) * length - at, F.size(v).cast("bigint"))
            return F.struct(
                chunk.alias("chunk_idx"),
                (start + at).alias("at"),
                F.slice(v, (start + 1).cast("int"), (stop - start).cast("int")).alias("part"),
            )

        def chunk_of(place: Column) -> Column:
            return ((place - place % length) / length).cast("bigint")

        chunks = F.sequence(chunk_of(at), chunk_of(at + F.size(v) - 1))
        return F.transform(F.when(F.size(v) > 0, chunks), one)

    pieces = placed.select(file, F.inline(let(F.col(ids), lambda v: parts(v, F.col("at")))))
    whole = F.size("part") == block
    ragged = (
        pieces.filter(~whole).groupBy(file, "chunk_idx")
        .agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))
        .select(file, "chunk_idx",
                F.flatten(F.transform("parts", lambda p: p["part"])).alias(ids))
    )
    return pieces.filter(whole).select(file, "chunk_idx", F.col("part").alias(ids)).unionByName(ragged)


def pack_none(df: DataFrame) -> DataFrame:
    """Lists pass through unchanged, each one an example."""
    return df


def pack(df: DataFrame, trim: int | None = None, block: int | None = None,
         eos: int = EOS_ID) -> DataFrame:
    """Choose the packing: ``block`` wins over ``trim``; without either, none.

    Always gives ``examples(file, doc_id, ex_idx, ids)``; with ``block`` the chunk number
    of the file takes the place of ``doc_id``.
    """
    if block is not None:
        examples = chunk_block(df, block).withColumnRenamed("chunk_idx", "doc_id")
    elif trim is not None:
        return pack_trim(df, trim, eos)
    else:
        examples = pack_none(df)
    return examples.withColumn("ex_idx", F.lit(0)).select("file", "doc_id", "ex_idx", "ids")


def _check_length(name: str, value: int) -> None:
    if value < 1:
        raise ValueError(f"{name} must be at least 1; leave it out to switch it off")
