"""Packing against brute force and by property."""

import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import ordering, packing

EOS = 2


def segments(ids):
    out, seg = [], []
    for x in ids:
        seg.append(x)
        if x == EOS:
            out.append(seg)
            seg = []
    return [*out, seg]


def greedy(ids, trim):
    """The rules, one segment at a time."""
    done, open_ = [], []
    for seg in segments(ids):
        if len(seg) > trim:
            done += [open_] if open_ else []
            done.append(seg[:trim])
            open_ = []
        elif len(open_) + len(seg) > trim:
            done.append(open_)
            open_ = seg
        else:
            open_ = open_ + seg
    return done + ([open_] if open_ else [])


def random_docs(n, seed):
    rng = random.Random(seed)
    docs = [[], [2], [2, 2, 2], [5] * 4, [5] * 5, [5] * 3 + [2], [5] * 4 + [2], [5, 2, 6, 6, 6],
            [5, 2, 6, 6, 6, 6, 6, 6]]
    for _ in range(n):
        docs.append([rng.choice([2, 5, 6, 7, 8]) for _ in range(rng.randint(0, 30))])
    return docs


def frame(spark, docs, files=3):
    rows = [(f"f{i % files}", i, d) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "file string, doc_id bigint, ids array<int>")


def test_split_at_eos(spark):
    docs = random_docs(200, 1)
    rows = packing.split_at_eos(frame(spark, docs)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.seg_idx)):
        got.setdefault(r.doc_id, []).append(r.ids)
    assert got == {i: segments(d) for i, d in enumerate(docs)}


@pytest.mark.parametrize("trim", [1, 4, 9])
def test_pack_trim(spark, trim):
    docs = random_docs(300, trim)
    rows = packing.pack_trim(frame(spark, docs), trim).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.ex_idx)):
        assert 0 < len(r.ids) <= trim
        got.setdefault(r.doc_id, []).append(r.ids)
    assert got == {i: greedy(d, trim) for i, d in enumerate(docs) if d}
    sizes = frame(spark, docs).select("doc_id", packing.count_packed(F.col("ids"), trim).alias("n"))
    assert {r.doc_id: r.n for r in sizes.collect() if r.n} == {k: len(v) for k, v in got.items()}


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_chunk_block(spark, block):
    docs = random_docs(200, block)
    rows = packing.chunk_block(frame(spark, docs), block).collect()
    for f in range(3):
        flat = [x for i, d in enumerate(docs) if i % 3 == f for x in d]
        mine = sorted((r.chunk_idx, r.ids) for r in rows if r.file == f"f{f}")
        assert [k for k, _ in mine] == list(range(len(mine)))
        assert [ids for _, ids in mine] == [flat[i:i + block] for i in range(0, len(flat), block)]


def test_offsets_with_far_apart_keys(spark):
    rng = random.Random(5)
    keys = [rng.randrange(-(2**62), 2**62) for _ in range(300)] + list(range(100)) + [2**16 * k for k in range(1, 90)]
    rows = [(f, k, rng.randint(0, 9)) for f in ("a", "b") for k in set(keys)]
    df = spark.createDataFrame(rows, "file string, doc_id bigint, n int")
    got = ordering.with_offsets(df, "file", "doc_id", F.col("n"), "at").collect()
    assert len(got) == len(rows)
    for f in ("a", "b"):
        total = 0
        for r in sorted((r for r in got if r.file == f), key=lambda r: r.doc_id):
            assert r["at"] == total
            total += r.n


def test_pack_chooses(spark):
    df = frame(spark, [[5, 2, 6, 2], [7, 2]], files=1)
    assert packing.pack(df, trim=2, block=4).count() == 2
    assert packing.pack(df, trim=2).count() == 3
    assert packing.pack(df).count() == 2
    with pytest.raises(ValueError):
        packing.pack(df, trim=0)
    with pytest.raises(ValueError):
        packing.pack(df, block=0)


def test_packing_and_masking_of_a_long_document_take_linear_time(spark):
    """Many blocks of segments give what one block after the other gives, and four times the ids about four times the time."""
    import time

    from tokenloom.operators import batches

    def document(n):
        ids = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i % 7 == 6, 2).otherwise(i % 1000 + 5))
        return spark.range(1).select(F.col("id").alias("doc_id"), ids.alias("ids"))

    seconds = {}
    for n in (80_000, 320_000):
        best = []
        for _ in range(2):
            begun = time.time()
            rows = packing.pack_trim(document(n), 16).orderBy("ex_idx").collect()
            best.append(time.time() - begun)
        seconds[n] = min(best)
        assert all(len(r.ids) == 14 for r in rows[:-1])
        assert [x for r in rows for x in r.ids] == [2 if i % 7 == 6 else i % 1000 + 5 for i in range(n)]
    assert seconds[320_000] < 8 * seconds[80_000] + 1
    masked = batches.whole_word_mask(document(80_000), 1100, ["doc_id"], lambda i: i % 3 == 0).first()
    assert sum(x != -100 for x in masked.labels) == 12_000
