"""Documents as token ids, packed into sequences of fixed length by the sum-of-squares rule.

Let N(g) be the number of open sequences with g free places. A piece of length s goes to
where the sum of all N(g)^2 becomes smallest: a sequence with gap g changes it by
2 (N(g - s) - N(g)) + 2 (without the term of a gap of 0), a new one by 2 N(C - s) + 1. Ties go to the smallest
gap. A new sequence is among the choices until as many are open as the total length needs at least;
after that only if no gap is large enough. Pieces are dealt to packing cells of bounded size by a hash and packed there on their own, long pieces first.
"""

from __future__ import annotations

import json
import math
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import byte_alphabet
from .common import MEMO_ENTRIES, bounded_batches, renamed, settle, tidy

LENGTH = 2048
CELL_PIECES = 200_000


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, taken in the given order; lengths from 1 to ``capacity``."""
    open_count = np.zeros(capacity + 1, np.int64)  # N(g); N(0) is not counted, closed sequences cost nothing
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    made, needed = 0, -(-int(lengths.sum()) // capacity)
    for i, s in enumerate(lengths.tolist()):
        after, before = open_count[:capacity - s + 1], open_count[s:]
        change = np.where(before > 0, 2 * (after - before) + 2, 1 << 60)
        change[0] = 1 - 2 * before[0] if before[0] else 1 << 60
        gap = int(change.argmin()) + s
        fresh = 2 * int(open_count[capacity - s]) + 1 if made < needed else (1 << 60) - 1
        if fresh < change[gap - s]:
            gap, b, made = capacity, made, made + 1
        else:
            b = by_gap[gap].pop()
            open_count[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            by_gap[gap - s].append(b)
            open_count[gap - s] += 1
    return bins, offsets


_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"  # how the tokenizer cuts a text
_LATIN = re.compile("[\\x00-\\x7fÀ-ÖØ-öø-ÿ]*")
_LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+", re.ASCII)
_SPELLED = dict(enumerate(byte_alphabet()))
CHUNK = 400


class _Parts(dict):
    """Ids of what the tokenizer cuts a word into, by the library's model alone once a part is new."""

    def __init__(self, model) -> None:
        self.tokenize = model.tokenize

    def __missing__(self, part: str) -> bytes:
        ids = array("I", [t.id for t in self.tokenize(part.encode().decode("latin-1").translate(_SPELLED))])
        found = self[part] = (ids if sys.byteorder == "little" else ids.byteswap() or ids).tobytes()
        return found


class WordEncoder:
    """Ids of whole texts from memoised words, for a tokenizer that lowers letters and drops white space.

    Such a tokenizer never joins what white space parts, so a text is the sum of its words. New words of a batch
    are encoded together; those in ASCII and Latin letters with accents are first cut where the tokenizer cuts them, since
    most differ from a known word in signs only, and their parts go to its model as they are. A tokenizer that cuts in another way gets whole words.
    """

    def __init__(self, path: str, limit: int = 2 * MEMO_ENTRIES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = _cuts_alike(json.loads(self.tokenizer.to_str()))
        self.words: dict[str, bytes] = {}
        self.parts = _Parts(self.tokenizer.model)
        self.limit = limit

    def _library(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        for i in range(0, len(parts), CHUNK):
            chunk = parts[i:i + CHUNK]
            found = self.tokenizer.encode(" ".join(chunk), add_special_tokens=False)
            ends = np.cumsum([len(p) + 1 for p in chunk])
            cuts = [0, *np.searchsorted([o[0] for o in found.offsets], ends).tolist()]
            ids = np.array(found.ids, "<u4").tobytes()
            yield from ((p, ids[4 * a:4 * b]) for p, a, b in zip(chunk, cuts[:-1], cuts[1:], strict=True))

    def _learn(self, missing: set[str]) -> None:
        part, cut, latin = self.parts.__getitem__, _LATIN_PIECES.findall, _LATIN.fullmatch
        whole = []
        for w in missing:
            if self.cuts and latin(w) and "<|" not in w:
                self.words[w] = b"".join(map(part, cut(w.lower())))
            else:
                whole.append(w)
        self.words.update(self._library(whole))

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        wanted = set().union(*split)
        missing = wanted - self.words.keys()
        if missing:
            if len(self.words) + len(missing) > self.limit:  # all words of the batch are looked up, also those known before
                self.words.clear()
                self.parts.clear()
                missing = wanted
            self._learn(missing)
        word = self.words.__getitem__
        for words in split:
            yield b"".join(map(word, words))

    def __call__(self, text: str | None) -> list[int]:
        return np.frombuffer(next(self.encode_batch([text])), "<u4").tolist()


def _cuts_alike(spec: dict) -> bool:
    """Whether a tokenizer file normalises and cuts as ``_LATIN_PIECES`` does, and spells the parts by bytes."""
    steps = [(s["type"], s.get("pattern"), s.get("content")) for s in (spec["normalizer"] or {}).get("normalizers", [])]
    return steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] and \
        (spec["pre_tokenizer"] or {}).get("pretokenizers") == [
            {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per Python worker, so that its words serve later tasks."""
    return WordEncoder(path)


def _pieces(path: str, length: int, final: int, with_ids: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            encoded = encoder(path).encode_batch(batch.column("text").to_pylist())
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                array = np.append(np.frombuffer(ids, "<u4"), np.uint32(final))
                for piece, at in enumerate(range(0, len(array), length)):
                    part = array[at:at + length]
                    row = (doc, piece, at, len(part), zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)
    return run


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH, final: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: each text's ids and ``final``, cut every ``length`` ids.

    A null text is empty and gives the final id alone.
    """
    bounded_batches(docs.sparkSession)
    kind = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    texts = renamed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return texts.mapInArrow(tidy(_pieces(path, length, final, with_ids)), kind)


def pack(pieces: DataFrame, capacity: int = LENGTH, cell_pieces: int = CELL_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``; all columns stay.

    ``pieces`` should be a written table: it is read twice, once to count. Repeated rows are packed as
    often as they occur. An empty table gives none.
    """
    cells = max(1, math.ceil(pieces.count() / cell_pieces))
    schema = pieces.schema
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ", sequence_id bigint, offset bigint"

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        order = np.argsort(-lengths, kind="stable")
        bins, offsets = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        bins[order], offsets[order] = sum_of_squares(lengths[order], capacity)
        return table.drop(["_cell"]).append_column("sequence_id", pa.array(bins + (key[0].as_py() << 40))) \
            .append_column("offset", pa.array(offsets))

    cell = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(cells))
    return pieces.withColumn("_cell", cell).groupBy("_cell").applyInArrow(run, kind)


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, final: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Token pieces of all texts with their place: ``sequence_id`` and ``offset``. Other columns are ignored.

    The ids stay out of the packing cells: keys and lengths are packed, and the ids are joined to their places by a row number
    written with the pieces.
    """
    pieces = token_pieces(docs, path, length, final, id_col, text_col, with_ids)
    if not with_ids:
        return pack(settle(pieces, "pieces"), length)
    numbered = settle(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    places = pack(numbered.drop("ids"), length)
    return places.join(numbered.select("_row", "ids"), "_row").select(*pieces.columns, "sequence_id", "offset")
