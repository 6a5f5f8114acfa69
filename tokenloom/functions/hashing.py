"""Seeded pseudo-random values that every engine computes alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX_DIGITS = 4  # 16**4 = 65,536 histogram buckets at most


def seeded_hash(seed: int, *parts: Column | str) -> Column:
    """md5 of ``seed:part:part...`` as 32 hex digits."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def digits(hash_: Column, word: int) -> Column:
    """The ``word``-th group of eight hex digits, counted from 0."""
    return F.substring(hash_, 8 * word + 1, 8)


def below(hash_: Column, word: int, p: float) -> Column:
    """True with probability ``p``; compares hex digits, so nothing is parsed."""
    limit = round(p * 2**32)
    if limit >= 2**32:
        return F.lit(True)
    return digits(hash_, word) < F.lit(f"{limit:08x}")


def hash_int(hash_: Column, word: int) -> Column:
    """An integer in [0, 2**32)."""
    return F.conv(digits(hash_, word), 16, 10).cast("bigint")


def uniform(hash_: Column, word: int = 0) -> Column:
    """A double in [0, 1)."""
    return hash_int(hash_, word) / F.lit(4294967296.0)
