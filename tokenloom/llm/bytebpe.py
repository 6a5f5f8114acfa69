"""Byte-level BPE through a sentencepiece model that is written down from a rank file.

Every byte is mapped to one character and every token to the string of its bytes' characters. These are the
pieces of a BPE model, scored by negative rank, with identity normalisation and no added or
removed spaces, so that sentencepiece joins the same pair first as the rank file asks for. The model is
serialised field by field. Texts are cut by the pre-token pattern and each new pre-token is
encoded once; decoding maps ids to pieces and characters back to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, renamed, tidy

MEMO = 1 << 19
FIRST_CHARACTER = 0x4E00  # bytes become letters that no normaliser or space rule touches


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order; ranks must run from 0 without gaps and hold all single bytes."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or any(bytes((b,)) not in ranks for b in range(256)):
        raise ValueError("ranks with gaps, or without some byte")
    return tokens


def byte_mapped(token: bytes) -> str:
    return "".join(chr(FIRST_CHARACTER + b) for b in token)


def unmapped(piece: str) -> bytes:
    return bytes(ord(c) - FIRST_CHARACTER for c in piece)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _flag(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model: piece 0 is unknown, piece ``rank + 1`` the token."""
    # Fixed numbers of the public model format: pieces 1 (piece 1, score 2, type 3), trainer 2 (type 3:
    # 2 = BPE, vocabulary size 4), normaliser 3 (name 1, dummy prefix 3, extra spaces 4, escaped spaces 5).
    parts = [_field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + _flag(3, 2))]
    for rank, token in enumerate(tokens):
        parts.append(_field(1, _field(1, byte_mapped(token).encode()) + b"\x15" + struct.pack("<f", -rank)))
    parts.append(_field(2, _flag(3, 2) + _flag(4, len(tokens) + 1)))
    parts.append(_field(3, _field(1, b"identity") + _flag(3, 0) + _flag(4, 0) + _flag(5, 0)))
    return b"".join(parts)


class ByteCodec:
    """Encoding and decoding of whole texts; pre-tokens are remembered."""

    def __init__(self, path: str, pattern: str) -> None:
        import sentencepiece

        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.tokens = [unmapped(self.model.IdToPiece(i + 1)) for i in range(len(tokens))]
        self.cut = regex.compile(pattern).findall
        self.memo: dict[str, bytes] = {}

    def _learn(self, missing: list[str]) -> None:
        unseen = []
        for word in missing:
            rank = self.ranks.get(word.encode())  # a whole token is taken as it is
            if rank is None:
                unseen.append(word)
            else:
                self.memo[word] = struct.pack("<I", rank)
        for word, ids in zip(unseen, self.model.EncodeAsIds([byte_mapped(w.encode()) for w in unseen], num_threads=1), strict=True):
            self.memo[word] = (np.array(ids, "<u4") - np.uint32(1)).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words = self.cut(text or "")
        distinct = set(words)
        if missing := [w for w in distinct if w not in self.memo]:
            if len(self.memo) + len(missing) > MEMO:  # all words of the text are looked up, also those known before
                self.memo.clear()
                missing = list(distinct)
            self._learn(missing)
        return b"".join(map(self.memo.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteCodec:
    """One per Python worker."""
    return ByteCodec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)`` with ids as packed unsigned 32-bit integers and the bytes they decode to.

    A null text is empty and has no ids. Other columns are ignored; an empty table gives none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(path, pattern)
        for batch in batches:
            ids = [both.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(both.decode, ids), pa.binary())], schema=schema)

    bounded_batches(docs.sparkSession)
    texts = renamed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return texts.mapInArrow(tidy(run), "doc_id bigint, ids binary, decoded binary")
