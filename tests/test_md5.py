"""Values hashed side by side against hashlib."""

import hashlib
import random

import numpy as np

from tokenloom.functions.md5 import md5_numbered


def test_numbered_messages_equal_hashlib():
    rng = random.Random(3)
    for longest in (20, 90):
        texts = [b"", *(bytes(rng.choices(range(256), k=rng.randint(0, longest))) for _ in range(300))]
        row = np.array([rng.randrange(len(texts)) for _ in range(9000)])
        number = np.array([rng.choice([0, 9, 10, 99, 100, rng.randrange(10**9), 10**17]) for _ in range(9000)])
        found = md5_numbered(texts, row, number)
        for i in range(len(row)):
            assert "".join(f"{w:08x}" for w in found[:, i]) == hashlib.md5(texts[row[i]] + str(number[i]).encode()).hexdigest()


def test_no_messages():
    assert md5_numbered([], np.empty(0, np.int64), np.empty(0, np.int64)).shape == (4, 0)
