"""Byte-level pieces of many texts at once, in NumPy, as ``text.pieces`` cuts them one by one."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACE, LETTER, NUMBER, OTHER = b" a0."  # the classes that the piece pattern tells apart
BLOCK = 0x800  # code points a row of the class table holds; the surrogates are one block
SURROGATE_BLOCK = 0xD800
CODE_POINTS = 0x110000
ASCII = 128
PART_BYTES, CUT_BYTES = 4 << 20, 1 << 18  # of text whose pieces are given at a time, and cut at a time, to stay in the cache
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")  # what follows an apostrophe as one piece with it


@lru_cache(maxsize=2)
def _classes(app: str, spark: SparkSession) -> bytes:
    blocks = [(at, "".join(map(chr, range(at, at + BLOCK)))) for at in range(0, CODE_POINTS, BLOCK) if at != SURROGATE_BLOCK]
    shown = F.col("chars")
    for pattern, sign in ((r"(?U)[^\s\p{L}\p{N}]", OTHER), (r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"(?U)\s", SPACE)):
        shown = F.regexp_replace(shown, pattern, chr(sign))
    found = dict(spark.createDataFrame(blocks, "at int, chars string").select("at", shown).collect())
    return "".join(found.get(at, chr(OTHER) * BLOCK) for at in range(0, CODE_POINTS, BLOCK)).encode("ascii")


def character_classes(spark: SparkSession) -> bytes:
    """The class of each code point by Spark's regular expressions, whose Unicode version may differ from Python's."""
    return _classes(spark.sparkContext.applicationId, spark)


def readable(text: Column) -> Column:
    """The text as Spark's regular expressions see it: broken UTF-8 becomes U+FFFD."""
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(F.encode(text, "UTF-8"), "UTF-8"))


def bounded(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Runs of texts with at most ``most`` bytes each, and at least one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def cut_parts(texts: pa.Array, *how) -> Iterator[pa.ListArray]:
    """What ``cut`` gives, for runs of texts of bounded size."""
    for part in bounded(texts, PART_BYTES):
        yield pa.concat_arrays([cut(few, *how) for few in bounded(part, CUT_BYTES)])


def cut(texts: pa.Array, classes: bytes, specials: Sequence[str] = (), add_prefix_space: bool = False) -> pa.ListArray:
    """The pieces of each text, as ``text.pieces_with_specials`` gives them; null for null."""
    blobs = pc.fill_null(texts.cast(pa.binary()), b"")
    sizes = pc.binary_length(blobs).to_numpy(zero_copy_only=False)
    rows = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    raw = b"".join(blobs.to_pylist())
    text = raw.decode()
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if len(codes) < len(raw):
        rows = np.searchsorted(_places(codes), rows)
    first = np.zeros(len(codes) + 1, bool)  # where a text, or a segment between special tokens, begins
    first[rows] = True
    whole = _mark_specials(codes, first, specials)
    if add_prefix_space:
        bare = first[:-1] & (codes != ord(" "))
        for at, _ in whole:
            bare[at] = False
        at = np.flatnonzero(bare)
        rows, whole = rows + np.searchsorted(at, rows), [(places + np.searchsorted(at, places), n) for places, n in whole]
        codes, first = np.insert(codes, at, ord(" ")), np.insert(first, at, True)
        first[at + np.arange(len(at)) + 1] = False
        raw = codes.tobytes().decode("utf-32-le").encode()
    begins = _beginnings(codes, first, classes)
    for places, n in whole:
        for k in range(1, n):
            begins[places + k] = False
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(codes)) if len(codes) == len(raw) else _places(codes)[np.append(starts, len(codes))]
    found = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, rows), pa.int32()), found, mask=texts.is_null())


def _places(codes: np.ndarray) -> np.ndarray:
    """The place of each character, and of the end, in the UTF-8 bytes."""
    wide = np.ones(len(codes), np.int8)
    for least in (0x80, 0x800, 0x10000):
        wide += codes >= least
    places = np.zeros(len(codes) + 1, np.int32)
    np.cumsum(wide, out=places[1:])
    return places


def _mark_specials(codes: np.ndarray, first: np.ndarray, specials: Sequence[str]) -> list[tuple[np.ndarray, int]]:
    """Mark in ``first`` where special tokens begin and end; the places and length of those that are a segment."""
    found = []
    for special in filter(None, specials):
        at = np.flatnonzero(codes == ord(special[0]))
        at = at[at + len(special) <= len(codes)]
        for k, char in enumerate(special[1:], 1):
            at = at[(codes[at + k] == ord(char)) & ~first[at + k]]
        found.append((at, len(special)))
    for at, n in found:
        first[at] = first[at + n] = True
    for j, (at, n) in enumerate(found):
        for k in range(1, n):
            at = at[~first[at + k]]
        found[j] = at, n
    return found


def _beginnings(codes: np.ndarray, first: np.ndarray, classes: bytes) -> np.ndarray:
    """Whether a piece begins at each character, by the public GPT-2 pattern."""
    if not len(codes):
        return np.zeros(0, bool)
    low = np.minimum(codes, ASCII).astype(np.uint8).tobytes().translate(classes[:ASCII] + bytes([OTHER]) * ASCII)
    kind = np.frombuffer(low, np.uint8)
    wide = np.flatnonzero(codes >= ASCII)
    if len(wide):
        kind = kind.copy()
        kind[wide] = np.frombuffer(classes, np.uint8)[codes[wide]]
    inner = ~first[1:-1]
    space, blank = kind == SPACE, codes == ord(" ")
    begins = first[:-1].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    begins[1:] &= ~(blank[:-1] & ~space[1:] & inner)  # a space joins what follows it,
    begins[:-1] |= space[:-1] & ~space[1:] & inner  # and the last of some white space stands apart
    _join_endings(codes, first, begins)
    return begins


def _join_endings(codes: np.ndarray, first: np.ndarray, begins: np.ndarray) -> None:
    """'s, 't, 're, 've, 'm, 'll and 'd are pieces where a piece begins with the apostrophe."""
    at = np.flatnonzero((codes == ord("'")) & begins)
    at = at[at + 1 < len(codes)]
    at = at[~first[at + 1]]
    ends = [at[np.isin(codes[at + 1], [ord(c) for c in ONE_LETTER])] + 2]
    at = at[at + 2 < len(codes)]
    at = at[~first[at + 2]]
    for one, two in TWO_LETTERS:
        ends.append(at[(codes[at + 1] == ord(one)) & (codes[at + 2] == ord(two))] + 3)
    begins[ends[0] - 1] = False
    for end in ends[1:]:
        begins[end - 2] = False
    ends = np.concatenate(ends)
    begins[ends[ends < len(codes)]] = True
