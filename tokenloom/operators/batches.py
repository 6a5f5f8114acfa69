"""Batch assembly: padding, label columns and masking as deterministic tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import BATCH_SIZE, IGNORE_LABEL, MASK_ID, MASK_RATE, PAD_ID, SPECIAL_TOKENS
from ..functions.columns import let
from ..functions.compact import compact, spread_out
from ..functions.hashing import below, hash_int, seeded_hash
from ..functions.md5 import md5_numbered
from ..session import written
from .ordering import join_places

MASKED_SHARE, RANDOM_SHARE = 0.8, 0.1  # of the chosen tokens; the others keep their id
MASKED_AT_A_TIME = 1 << 18  # tokens


def pad_to(values: Column, width: Column | int, fill: int) -> Column:
    """The list, filled up on the right."""
    width = F.lit(width) if isinstance(width, int) else width
    missing = F.greatest(width - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(fill), missing))


def attention_mask(values: Column, width: Column | int) -> Column:
    """1 on real tokens, 0 on padding."""
    return pad_to(F.transform(values, lambda _: F.lit(1)), width, 0)


def batch_pad(examples: DataFrame, size: int = BATCH_SIZE, pad: int = PAD_ID, ids: str = "ids",
              labels: str | None = None) -> DataFrame:
    """``batches(batch_id, row, input_ids, attention_mask[, labels])``.

    ``pos`` numbers the examples from 0; each ``size`` consecutive ones form a batch and
    are padded to its longest. Labels, where given, are padded with the ignore label.
    """
    placed = examples.withColumn("batch_id", F.expr(f"pos div {int(size)}"))
    width = F.max(F.size(ids)).over(W.partitionBy("batch_id"))
    return _padded(placed.withColumn("width", width), size, pad, ids, labels)


def ordered_batches(examples: DataFrame, place: Callable[[DataFrame, Sequence[str]], DataFrame], keys: Sequence[str],
                    size: int = BATCH_SIZE, pad: int = PAD_ID, ids: str = "ids", labels: str | None = None,
                    lengths_of: tuple[DataFrame, str] | None = None) -> DataFrame:
    """``batch_pad`` of the examples in the order of ``place``, which adds ``pos`` to rows of ``keys``.

    ``place`` is ``file_positions``, ``shuffle_files`` or ``shuffle_rows``, for a given seed perhaps. Keys and lengths alone
    are written once, numbered and measured by batch; the ids are shuffled once, to meet their place. The keys identify
    a row. ``lengths_of``, a table with the same keys and lengths and the name of its ids, spares the work that made ``examples``.
    """
    source, name = lengths_of or (examples, ids)
    narrow = written(source.select(*keys, F.size(name).alias("_n")), "lengths")
    return _padded(_with_places(examples, narrow, place, keys, size), size, pad, ids, labels)


def _with_places(examples: DataFrame, narrow: DataFrame, place: Callable[[DataFrame, Sequence[str]], DataFrame],
                 keys: Sequence[str], size: int) -> DataFrame:
    """Add ``pos``, ``batch_id`` and ``width``, the longest of the batch, from ``narrow``, the keys and their lengths ``_n``."""
    placed = place(narrow, keys).withColumn("batch_id", F.expr(f"pos div {int(size)}"))
    width = F.max("_n").over(W.partitionBy("batch_id"))
    return join_places(examples, placed.select(*keys, "pos", "batch_id", width.alias("width")), keys)


def _padded(padded: DataFrame, size: int, pad: int, ids: str, labels: str | None) -> DataFrame:
    columns = [
        "batch_id",
        (F.col("pos") % size).cast("int").alias("row"),
        pad_to(F.col(ids), F.col("width"), pad).alias("input_ids"),
        attention_mask(F.col(ids), F.col("width")).alias("attention_mask"),
    ]
    if labels:
        columns.append(pad_to(F.col(labels), F.col("width"), IGNORE_LABEL).alias("labels"))
    return padded.select(*columns)


def clm_labels(batches: DataFrame, pad: int = PAD_ID) -> DataFrame:
    """Add ``labels``: the ids themselves, padding ignored."""
    labels = F.transform("input_ids", lambda x: F.when(x == pad, IGNORE_LABEL).otherwise(x))
    return batches.withColumn("labels", labels)


def tokcls_pad(aligned: DataFrame, size: int = BATCH_SIZE, pad: int = PAD_ID,
               place: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None,
               keys: Sequence[str] = ("sent_id",)) -> DataFrame:
    """Batches of label-aligned sentences: ids padded with ``pad``, labels with the ignore label.

    In the order of ``pos``, or of ``place`` as in ``ordered_batches``; then the aligned rows, which cost a tokenizer's
    work, are written once and read twice. Only keys, lengths, ids and labels are written and shuffled; the lists are shuffled as short binary values.
    """
    if place is None:
        return batch_pad(aligned, size, pad, ids="input_ids", labels="labels")
    lists = ("input_ids", "labels")
    short = [name for name in lists if aligned.schema[name].dataType == T.ArrayType(T.IntegerType(), aligned.schema[name].dataType.containsNull)]
    rows = written(aligned.select(*keys, F.size("input_ids").alias("_n"), *lists), "aligned", compression="zstd")
    packed = rows.drop("_n").withColumns({n: compact(n) for n in short})
    placed = _with_places(packed, rows.select(*keys, "_n"), place, keys, size)
    return _padded(placed.withColumns({n: spread_out(n) for n in short}), size, pad, *lists)


def fit_length(df: DataFrame, max_len: int, pad: int = PAD_ID, ids: str = "ids") -> DataFrame:
    """Cut or right-pad the ids to exactly ``max_len``; adds ``attention_mask``."""
    kept = F.slice(ids, 1, max_len)
    return df.withColumn("attention_mask", attention_mask(kept, max_len)).withColumn(
        ids, pad_to(kept, max_len, pad)
    )


def _masked(df: DataFrame, chosen: Callable[[Column, Column, Column], Column], keys: Sequence[str],
            ids: str, vocab_size: int, seed: int) -> DataFrame:
    """Replace the chosen tokens and add ``input_ids`` and ``labels``.

    ``chosen(token, position, hash)`` decides. One hash per position gives all its random
    values; the inner ``transform`` binds it, so it is computed once.
    """
    key = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])

    def drawn(token: Column, i: Column) -> Column:
        h = seeded_hash(seed, key, i)
        return F.struct(token.alias("id"), i.alias("i"), h.alias("h"))

    def outcome(z: Column) -> Column:
        new = (
            F.when(below(z["h"], 1, MASKED_SHARE), F.lit(MASK_ID))
            .when(below(z["h"], 1, MASKED_SHARE + RANDOM_SHARE),
                  (hash_int(z["h"], 2) % vocab_size).cast("int"))
            .otherwise(z["id"])
        )
        hit = chosen(z["id"], z["i"], z["h"])
        return F.struct(
            F.when(hit, new).otherwise(z["id"]).alias("id"),
            F.when(hit, z["id"]).otherwise(F.lit(IGNORE_LABEL)).alias("label"),
        )

    pairs = F.transform(F.transform(ids, drawn), outcome)
    columns = [c for c in df.columns if c != ids]
    both = let(pairs, lambda p: F.struct(
        F.transform(p, lambda z: z["id"]).alias("input_ids"),
        F.transform(p, lambda z: z["label"]).alias("labels"),
    ))
    return df.select(*columns, F.inline(F.array(both)))


def mlm_mask(df: DataFrame, vocab_size: int, keys: Sequence[str], p: float = MASK_RATE,
             seed: int = 0, ids: str = "ids", specials: int = len(SPECIAL_TOKENS)) -> DataFrame:
    """Choose each non-special token with probability ``p``; of those 80% become the mask
    token, 10% a random id, 10% stay. Labels hold the original id where chosen."""
    return _masked(
        df, lambda x, i, h: (x >= specials) & below(h, 0, p), keys, ids, vocab_size, seed
    )


def _taken(rows: np.ndarray, lengths: np.ndarray, budgets: np.ndarray) -> list[int]:
    """The words that fit the budget of their row, which come first; words are sorted by row."""
    bounds = np.searchsorted(rows, np.arange(len(budgets) + 1)).tolist()
    sizes, taken = lengths.tolist(), []
    for start, stop, left in zip(bounds, bounds[1:], budgets.tolist()):
        for j in range(start, stop):
            if sizes[j] <= left:
                taken.append(j)
                left -= sizes[j]
                if not left:
                    break
    return taken


def _mask_words(ids: pa.ListArray, starts: pa.ListArray, keys: pa.Array, vocab_size: int, p: float, seed: int,
                specials: int) -> pa.StructArray:
    """``whole_word_mask`` of some lists, laid end to end."""
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    flat = ids.flatten()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, specials).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(values)) - offsets[row]
    special = values < specials
    begins = (at == 0) | special | np.concatenate([[False], special[:-1]])[:len(special)]
    begins |= pc.fill_null(starts.flatten(), False).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(begins)
    length = np.diff(np.append(first, len(values)))
    usable = known[first] & ~special[first]
    first, length = first[usable], length[usable]
    names = [f"{seed}:{key}:".encode() for key in keys.to_pylist()]
    h = md5_numbered([name + b"w:" for name in names], row[first], at[first])
    order = np.lexsort((first, *h[::-1], row[first]))
    first, length = first[order], length[order]
    taken = _taken(row[first], length, np.maximum(np.rint(sizes * float(p)), 1).astype(np.int64))
    edges = np.zeros(len(values) + 1, np.int8)  # words are apart, so that an end and a start may meet
    np.add.at(edges, first[taken], 1)
    np.add.at(edges, first[taken] + length[taken], -1)
    hits = np.flatnonzero(np.cumsum(edges[:-1]))
    h = md5_numbered(names, row[hits], at[hits])
    masked, drawn = h[1] < round(MASKED_SHARE * 2**32), h[1] < round((MASKED_SHARE + RANDOM_SHARE) * 2**32)
    new = values.copy()
    new[hits] = np.where(masked, MASK_ID, np.where(drawn, h[2].astype(np.int64) % vocab_size, values[hits]))
    labels = np.full_like(values, IGNORE_LABEL)
    labels[hits] = values[hits]
    kept = known.copy()
    kept[hits] |= drawn
    told = np.ones(len(values), bool)
    told[hits] = known[hits]
    lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, flat.type, mask=~valid), mask=ids.is_null())
             for v, valid in ((new, kept), (labels, told))]
    return pa.StructArray.from_arrays(lists, ["input_ids", "labels"])


def whole_word_mask(df: DataFrame, vocab_size: int, keys: Sequence[str],
                    starts: Callable[[Column], Column], p: float = MASK_RATE, seed: int = 0,
                    ids: str = "ids", specials: int = len(SPECIAL_TOKENS)) -> DataFrame:
    """Choose whole words until ``max(1, round(n * p))`` tokens are chosen, skipping a word
    that would overshoot; then replace as in ``mlm_mask``.

    ``starts`` tells from a token id whether a word begins there; position 0 always does. A special token stands alone
    and is never chosen. The other words are visited in hash order and taken while they fit the budget. Hashes
    are drawn only for words, and for the tokens of chosen ones.
    """
    kind = df.schema[ids].dataType.elementType.simpleString()

    @F.arrow_udf(f"struct<input_ids: array<{kind}>, labels: array<{kind}>>")
    def masked(lists: pa.Array, flags: pa.Array, names: pa.Array) -> pa.Array:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        parts, start = [], 0
        while start < len(lists) or not parts:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + MASKED_AT_A_TIME, "right")))
            part = (column.slice(start, stop - start) for column in (lists, flags, names))
            parts.append(_mask_words(*part, vocab_size, p, seed, specials))
            start = stop
        return pa.concat_arrays(parts)

    key = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    columns = [c for c in df.columns if c != ids]
    return df.select(*columns, F.inline(F.array(masked(F.col(ids), F.transform(ids, starts), key))))
