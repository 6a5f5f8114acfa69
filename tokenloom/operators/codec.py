"""Text to token ids and back."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import byte_alphabet
from ..functions.cutting import CUT_BYTES, _mark_specials, _places, bounded, character_classes, cut_parts, readable
from ..functions.fragments import Joints, strings
from ..functions.text import from_byte_symbols
from .bpe import BPE, WORDPIECE, PieceMerger, Tokenizer
from .wordpiece import LongestMatch

MAX_VOCAB = 1_000_000  # proven bound on what is broadcast: one entry per token or merge
MAX_UNIT_CHARS = 100  # of a WordPiece unit, as in the usual models
MEMO_PIECES = 500_000  # pieces a worker remembers; more are encoded again
MEMO_CHARS = 16_000_000  # of those pieces and their ids
PART_BYTES = 2 << 20  # of pieces encoded at a time
HEAD_MARK, INNER_MARK, NO_MATCH = "0", "1", -1  # of WordPiece fragments that begin a unit and of others; the id of what no token matches


def _bounded(df: DataFrame) -> list:
    rows = df.limit(MAX_VOCAB + 1).collect()
    if len(rows) > MAX_VOCAB:
        raise ValueError(f"a tokenizer table has more than {MAX_VOCAB} rows")
    return rows


def vocab_tokens(tok: Tokenizer) -> list[str]:
    """The tokens in id order."""
    return [row.token for row in sorted(_bounded(tok.vocab), key=lambda row: row.id)]


def _checked(tok: Tokenizer, kind: str) -> list[str]:
    """The tokens in id order, after a look at the kind and the ids."""
    if tok.kind != kind:
        raise ValueError(f"a {kind} tokenizer is needed, not {tok.kind}")
    rows = sorted((row.id, row.token) for row in _bounded(tok.vocab))
    if [i for i, _ in rows] != list(range(len(rows))):
        raise ValueError("token ids must be 0, 1, 2, ...")
    return [token for _, token in rows]


def _encoder(spark, shared: tuple, start: Callable, nested: bool, cutting: tuple | None = None) -> Callable:
    """A column function: array of pieces -> array of id arrays, one per piece. With ``cutting``, the arguments of
    ``cut_parts``, it takes texts instead and cuts them first.

    ``start`` makes, from the broadcast ``shared``, the ids known from the outset and the function for other pieces. Each
    Arrow batch is reduced to its distinct pieces before any of them is encoded, and the ids are spread back by index
    arithmetic; a batch of long texts is taken in parts of bounded size, and a worker remembers pieces up to a bound of
    characters too. Without ``nested`` the ids of a row are one flat array.
    """
    tables = spark.sparkContext.broadcast((shared, cutting))

    @F.arrow_udf("array<array<int>>" if nested else "array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shared, cutting = tables.value
        memo = _Memo(*start(*shared))
        for lists in (part for batch in batches for part in (cut_parts(batch, *cutting) if cutting else _bounded_parts(batch))):
            found = pc.dictionary_encode(lists.flatten())
            at, ids, starts = memo.coded(found.dictionary.cast(pa.string()))
            yield _spread(lists, at[found.indices.to_numpy(zero_copy_only=False)], ids, starts, nested)

    return encode


class _Memo:
    """The ids of pieces, of which those seen first are remembered, up to a number and a bound of characters."""

    def __init__(self, known: dict[str, int], encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]):
        self.pieces = pa.array(list(known), pa.string())
        self.ids = np.array(list(known.values()), np.int32)
        self.starts = np.arange(len(known) + 1)  # of each piece in ``ids``, and their end
        self.encode, self.left, self.room = encode, MEMO_PIECES, MEMO_CHARS

    def coded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each of the distinct pieces a place in ``starts``, and ``ids`` and ``starts`` themselves."""
        at = pc.fill_null(pc.index_in(pieces, value_set=self.pieces), -1).to_numpy(zero_copy_only=False).copy()
        unseen = np.flatnonzero(at < 0)
        if not len(unseen):
            return at, self.ids, self.starts
        new = pieces.take(pa.array(unseen))
        found, sizes = self.encode(new)
        at[unseen] = len(self.pieces) + np.arange(len(unseen))
        ids = np.concatenate([self.ids, found])
        starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes)])
        used = np.cumsum(pc.utf8_length(new).to_numpy(zero_copy_only=False) + sizes)
        kept = min(self.left, int(np.searchsorted(used, self.room, "right")))
        if kept:
            self.left, self.room = self.left - kept, self.room - int(used[kept - 1])
            self.pieces = pa.concat_arrays([self.pieces, new.slice(0, kept)])
            self.starts = starts[:len(self.starts) + kept]
            self.ids = ids[:self.starts[-1]]
        return at, ids, starts


def _bounded_parts(lists: pa.ListArray) -> Iterator[pa.ListArray]:
    """Runs of rows with at most ``PART_BYTES`` of pieces each, and at least one row."""
    sizes = pc.fill_null(pc.binary_length(lists.flatten()), 0).to_numpy(zero_copy_only=False)
    per_row = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[np.cumsum(per_row, dtype=np.int64)]
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PART_BYTES, "right")))
        yield lists.slice(start, stop - start)
        start = stop


def piece_encoder(tok: Tokenizer, specials: Sequence[str] | None = None,
                  nested: bool = True, cutting: tuple | None = None) -> Callable:
    """``_encoder`` for byte-level pieces, which are merged. Workers share the merges by broadcast."""
    tokens = _checked(tok, BPE)
    ids = {token: i for i, token in enumerate(tokens)}
    merges = sorted((m.rank, m.left, m.right, m.new_id) for m in _bounded(tok.merges))
    shared = (
        np.array([ids[char] for char in byte_alphabet()], np.int32),
        np.array(merges, np.int64).reshape(-1, 4),
        {s: ids[s] for s in (tok.specials if specials is None else specials)},
    )

    def start(of_byte: np.ndarray, merges: np.ndarray, known: dict) -> tuple[dict, Callable]:
        merger = PieceMerger(merges)

        def coded(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            sizes = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
            return merger(of_byte[np.frombuffer(b"".join(pieces.cast(pa.binary()).to_pylist()), np.uint8)], sizes)

        return known, coded

    return _encoder(tok.vocab.sparkSession, shared, start, nested, cutting)


def wordpiece_encoder(tok: Tokenizer, max_chars: int, specials: Sequence[str]) -> Callable:
    """A column function: texts -> ids by longest match of each segment between special tokens; a segment
    that has no match, or is too long, is unknown.

    No token lies across two characters that stand side by side in no token. Segments are cut there, the distinct fragments
    of many texts are matched, and a worker remembers them up to a bound.
    """
    tokens = _checked(tok, WORDPIECE)
    ids = {token: i for i, token in enumerate(tokens)}
    known = {**{HEAD_MARK + s: ids[s] for s in specials}, HEAD_MARK: ids[tok.unknown]}
    tables = tok.vocab.sparkSession.sparkContext.broadcast((tokens, tok.prefix, tuple(specials), known, max_chars))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, prefix, specials, known, max_chars = tables.value
        match = LongestMatch(tokens, prefix)
        pairs = {pair for token in tokens for pair in zip(token, token[1:])}
        joints = Joints(*(np.array([ord(pair[side]) for pair in pairs], np.int32) for side in (0, 1)))

        def coded(fragments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            ids, sizes = array("i"), []
            for fragment in fragments.to_pylist():
                found = match(fragment[1:], fragment[0] != HEAD_MARK)
                found = [NO_MATCH] if found is None else found
                ids.extend(found)
                sizes.append(len(found))
            return np.array(ids, np.int32), np.array(sizes, np.int64)

        memo = _Memo(known, coded)
        unknown = list(known).index(HEAD_MARK)
        for part in (part for batch in batches for part in bounded(batch, PART_BYTES)):
            cut = [_fragments(few, joints, specials) for few in bounded(part, CUT_BYTES)]
            found = pc.dictionary_encode(pa.concat_arrays([c[0] for c in cut]))
            heads, long, per_row = (np.concatenate([c[k] for c in cut]) for k in (1, 2, 3))
            at, ids, starts = memo.coded(found.dictionary)
            at = at[found.indices.to_numpy(zero_copy_only=False)]
            segment = np.cumsum(heads) - 1
            bad = long > max_chars
            bad[segment[at < len(known)]] = False  # special tokens
            bad[segment[ids[starts[at]] == NO_MATCH]] = True
            at[heads & bad[segment]] = unknown
            kept = heads | ~bad[segment]
            rows = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(per_row)])]
            lists = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.nulls(int(rows[-1])), mask=part.is_null())
            yield _spread(lists, at[kept], ids, starts, nested=False)

    return encode


def _fragments(texts: pa.Array, joints: Joints, specials: Sequence[str]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The fragments of the texts, with a mark before each; whether they begin a segment; the characters of each
    segment; the number of fragments of each text."""
    blobs = pc.fill_null(texts.cast(pa.binary()), b"")
    rows = np.concatenate([[0], np.cumsum(pc.binary_length(blobs).to_numpy(zero_copy_only=False), dtype=np.int64)])
    raw = b"".join(blobs.to_pylist())
    codes = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
    if len(codes) < len(raw):
        rows = np.searchsorted(_places(codes), rows)
    first = np.zeros(len(codes) + 1, bool)
    first[rows] = True
    _mark_specials(codes, first, specials)
    begins = first[:-1].copy()
    begins[1:] |= ~joints(codes[:-1], codes[1:])
    starts, heads = np.flatnonzero(begins), np.flatnonzero(first[:-1])
    marks = np.where(first[starts], ord(HEAD_MARK), ord(INNER_MARK))
    found = strings(np.insert(codes, starts, marks), starts + np.arange(len(starts)))
    return found, first[starts], np.diff(heads, append=len(codes)), np.diff(np.searchsorted(starts, rows))


def _spread(lists: pa.ListArray, at: np.ndarray, ids: np.ndarray, starts: np.ndarray,
            nested: bool) -> pa.ListArray:
    """Id lists for the pieces whose ids lie from ``starts[at]`` on, grouped as in ``lists``."""
    lens = (starts[1:] - starts[:-1])[at]
    ends = np.cumsum(lens)
    source = np.repeat(starts[at] - (ends - lens), lens) + np.arange(lens.sum())
    items = pa.array(ids[source], pa.int32())
    stops = np.concatenate([[0], ends])
    per_row = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    rows = np.concatenate([[0], np.cumsum(per_row)])
    if nested:
        items = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), items)
    else:
        rows = stops[rows]
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), items, mask=lists.is_null())


def encode(df: DataFrame, tok: Tokenizer, text: str = "text", out: str = "ids",
           add_prefix_space: bool = False, specials: Sequence[str] | None = None,
           max_chars: int = MAX_UNIT_CHARS) -> DataFrame:
    """Add the token ids of ``text``. Literal special tokens become single ids; none are added.

    Needs no shuffle: Arrow workers cut the pieces and look them up. A WordPiece
    model takes each segment between special tokens as one unit, of at most ``max_chars``
    characters; a longer one, or one without a match, is the unknown token.
    """
    specials = tok.specials if specials is None else specials
    if tok.kind == WORDPIECE:
        return df.withColumn(out, wordpiece_encoder(tok, max_chars, specials)(readable(F.col(text))))
    cutting = character_classes(df.sparkSession), tuple(specials), add_prefix_space
    return df.withColumn(out, piece_encoder(tok, specials, nested=False, cutting=cutting)(readable(F.col(text))))


def _literal_list(items: Sequence[str]) -> Column:
    """A constant array, folded once by the optimizer, cut at a sign that no item holds."""
    used = set("".join(items))
    sign = next(c for c in map(chr, (32, *range(0xE000, 0xF8FF), *range(1, 32))) if c not in used)
    return F.split(F.lit(sign.join(items)), re.escape(sign))


def decode(df: DataFrame, tok: Tokenizer, ids: str = "ids", out: str = "text",
           skip_special_tokens: bool = True, specials: Sequence[str] | None = None,
           style: str = "text") -> DataFrame:
    """Add the text spelled by token ids.

    The vocabulary, one string per token, travels in the plan as a constant array, so the
    lookup is by index and needs neither a join nor a regrouping of the tokens. For a
    WordPiece model ``style`` tells how tokens are joined: ``text`` without their prefixes, which is the
    inverse of encoding, ``words`` with a space before tokens that have no prefix, and ``tokens`` with a space before each.
    """
    if style not in ("text", "words", "tokens"):
        raise ValueError(f"no style {style!r}")
    tokens = _checked(tok, tok.kind)
    specials = tok.specials if specials is None else specials
    kept = F.col(ids)
    if skip_special_tokens:
        special_ids = [i for i, token in enumerate(tokens) if token in set(specials)]
        kept = F.filter(kept, lambda i: ~i.isin(special_ids))
    names = _literal_list(tokens)
    spelled = F.transform(kept, lambda i: F.get(names, i))
    if tok.kind == BPE:
        return df.withColumn(out, from_byte_symbols(F.array_join(spelled, "")))
    if style != "tokens":
        gap = "" if style == "text" else " "
        spelled = F.transform(spelled, lambda t, i: F.when(i == 0, t).when(
            t.startswith(tok.prefix), F.substring(t, F.lit(len(tok.prefix) + 1), F.length(t))).otherwise(F.concat(F.lit(gap), t)))
    return df.withColumn(out, F.array_join(spelled, " " if style == "tokens" else ""))


def word_start_test(tok: Tokenizer) -> Callable[[Column], Column]:
    """A test on token ids: does the token begin with the byte-level space mark?"""
    mark = byte_alphabet()[ord(" ")]
    flags = _literal_list(["1" if t.startswith(mark) else "0" for t in vocab_tokens(tok)])
    return lambda i: F.get(flags, i) == "1"


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                added: str) -> DataFrame:
    """Apply ``fn`` to batches of rows; it returns them with the ``added`` columns."""
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(lambda batches: map(fn, batches), f"{names}, {added}")
