"""md5 of many short messages at once, for use inside Arrow functions.

The same values as ``hashing`` computes column by column: a message is a text followed by a whole number.
Messages of one block (55 bytes) are hashed side by side, longer ones one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np

_BLOCK = 8192  # messages side by side, so that their words stay in the cache
_ROOM = 55  # bytes of a message that fits one block
_SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = [np.uint32(int(abs(np.sin(i + 1)) * 2**32)) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _blocks(words: np.ndarray) -> np.ndarray:
    """Digest words of padded one-block messages, ``words(16, n)``."""
    n = words.shape[1]
    a, b, c, d = (np.full(n, s, np.uint32) for s in _START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        turn = i // 16
        if turn == 0:  # (b & c) | (~b & d)
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            g = i
        elif turn == 1:  # (d & b) | (~d & c)
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            g = (5 * i + 1) % 16
        elif turn == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            g = (3 * i + 5) % 16
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            g = 7 * i % 16
        f += a
        f += words[g]
        f += _SINES[i]
        shift = _SHIFTS[turn][i % 4]
        np.right_shift(f, np.uint32(32 - shift), out=t)
        f <<= np.uint32(shift)
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    return np.stack([x + np.uint32(s) for x, s in zip((a, b, c, d), _START)])


def md5_numbered(texts: Sequence[bytes], row: np.ndarray, number: np.ndarray) -> np.ndarray:
    """``(4, n)``: md5 of ``texts[row]`` followed by the decimal ``number``, which is not negative.

    Word ``k`` holds the hex digits 8k to 8k + 7 of the digest as an integer.
    """
    out = np.empty((4, len(row)), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    padded = np.array(texts, dtype="S64") if len(texts) else np.empty(0, "S64")
    table = padded.view(np.uint8).reshape(len(texts), 64)
    powers = 10 ** np.arange(1, 19)
    for start in range(0, len(row), _BLOCK):
        rows, numbers = row[start:start + _BLOCK], number[start:start + _BLOCK].astype(np.int64)
        digits = np.searchsorted(powers, numbers, "right") + 1
        ends = sizes[rows] + digits
        fits = ends <= _ROOM
        message = table[rows]
        if fits.all():
            every, left, last = slice(None), numbers, ends + np.arange(0, 64 * len(rows), 64)
        else:
            every = np.flatnonzero(fits)
            left, last = numbers[every], ends[every] + 64 * every
        flat, many = message.reshape(-1), digits[every]
        flat[last - 1] = left % 10 + 48
        for k in range(1, int(digits.max())):
            here = np.flatnonzero(many > k)
            flat[last[here] - 1 - k] = left[here] // powers[k - 1] % 10 + 48
        flat[last] = 0x80
        message[every, 56], message[every, 57] = ends[every] * 8 & 255, ends[every] >> 5
        found = _blocks(np.ascontiguousarray(message.view("<u4").T)).byteswap()
        for i in np.flatnonzero(~fits):
            digest = hashlib.md5(texts[rows[i]] + str(numbers[i]).encode(), usedforsecurity=False).digest()
            found[:, i] = np.frombuffer(digest, ">u4")
        out[:, start:start + _BLOCK] = found
    return out
