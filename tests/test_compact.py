"""Lists as short binary values."""

import random

import pyarrow as pa

from tokenloom.functions import compact


def test_lists_come_back(monkeypatch):
    monkeypatch.setattr(compact, "VALUES_AT_A_TIME", 150)
    kind, r = pa.list_(pa.int32()), random.Random(5)
    odd = [0, 5, 255, 256, 70_000, -100, -1, 2**31 - 1, -2**31]
    for k in range(200):
        holes, usual = r.choice([0, 0, 0.03]), r.choice([[7], [-100, -100, -100, 3], list(range(200))])
        rows = [None if r.random() < 0.1 else [
            None if r.random() < holes else r.choice(odd if r.random() < 0.1 * (k % 2) else usual) for _ in range(r.choice([0, 1, 3, 90]))]
            for _ in range(r.randrange(12))]
        packed = compact.pack(pa.array(rows, kind))
        assert compact.unpack(packed).to_pylist() == rows
        assert compact.unpack(packed.slice(len(rows) // 2)).to_pylist() == rows[len(rows) // 2:]


def test_labels_take_less_than_a_byte():
    labels = [3 if i % 6 == 0 else -100 for i in range(600)]
    assert compact.pack(pa.array([labels], pa.list_(pa.int32()))).nbytes < 300
