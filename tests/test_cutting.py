"""Pieces cut in NumPy against the column function, and merges of many pieces against one at a time."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.constants import SPECIAL_TOKENS
from tokenloom.functions import cutting
from tokenloom.functions.text import pieces_with_specials
from tokenloom.operators import bpe, codec

ATOMS = ["a", "s", "t", "re", "ve", "ll", "m", "d", "'", "' ", " ", "  ", "\n", "\t", " ", "\u0085", " ", "1", "²", "ⅷ", "é", "漢",
         "😀", "́", ".", ",", "<s>", "</s>", "<mask>", "<s", "s>", "<", "\x1c", "\x0b", "​", "𝟙", "\x00", "�", "\U0001f6dd"]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices(ATOMS, k=rng.randrange(14)))) for i in range(4000)] + [(4000, None)]
    return rows, spark.createDataFrame(rows, "k int, text string").cache()


@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("specials", [(), SPECIAL_TOKENS, ("<s>", "s>", "<s", "aa", "<s></s>", "a")])
def test_cuts_equal_the_pattern(spark, odd, specials, prefix):
    rows, df = odd
    want = dict(df.select("k", pieces_with_specials(F.col("text"), prefix, specials)).collect())
    texts = pa.array([text for _, text in rows], pa.string())
    classes = cutting.character_classes(spark)
    got = [p for k in range(0, len(rows), 777) for p in cutting.cut(texts.slice(k, 777), classes, specials, prefix).to_pylist()]
    assert got == [want[k] for k, _ in rows]


def test_every_character_has_the_class_of_the_pattern(spark):
    blocks = [(at, "".join(map(chr, range(at, at + 256)))) for at in range(0, 0x110000, 256) if not 0xD800 <= at < 0xE000]
    df = spark.createDataFrame(blocks, "k int, text string")
    want = dict(df.select("k", pieces_with_specials(F.col("text"), False, ())).collect())
    got = cutting.cut(pa.array([text for _, text in blocks]), cutting.character_classes(spark)).to_pylist()
    assert got == [want[k] for k, _ in blocks]


def test_counts_cross_parts_and_keep_broken_text(spark, monkeypatch):
    """Counts are right where workers send some of them early; broken UTF-8 is read as the pattern reads it."""
    rows = spark.sql("SELECT CAST(unhex('61ff20c3') AS STRING) AS text UNION ALL SELECT CAST(unhex('e28261f09f20') AS STRING)")
    df = rows.unionByName(spark.createDataFrame([(f"w{i % 9} x{i} it's",) for i in range(300)] + [(None,), ("",)], "text string"))
    want = dict(df.select(F.explode(pieces_with_specials(F.concat(F.lit(" "), F.col("text")), False, ())).alias("p"))
                .filter("p <> ' ' OR p IS NULL").groupBy("p").count().collect())
    for held in (4, bpe.HELD_PIECES):
        monkeypatch.setattr(bpe, "HELD_PIECES", held)
        monkeypatch.setattr(cutting, "PART_BYTES", 40)
        found = bpe.word_counts(df.coalesce(1)).collect()
        got = {r.piece: r.n for r in found if r.piece != " "}
        assert got == want and len(found) == len({r.piece for r in found})


def one_piece(ids, merges):
    """Merge one piece, lowest rank first."""
    best = {(left, right): (rank, new) for rank, left, right, new in sorted(merges, reverse=True)}
    while found := set(zip(ids, ids[1:])) & best.keys():
        pair = min(found, key=best.__getitem__)
        out = []
        for i in ids:
            if out and (out[-1], i) == pair:
                out[-1] = best[pair][1] + 1_000_000  # not merged again in this step
            else:
                out.append(i)
        ids = [i % 1_000_000 for i in out]
    return ids


def test_many_pieces_merge_like_one_at_a_time():
    rng = random.Random(2)
    for size in (0, 1, 3, 40):
        known, merges = list(range(4)), []
        for rank in range(size):  # some make a token that is there already
            new = rng.choice(known) if rng.random() < 0.2 else len(known)
            merges.append((rank, rng.choice(known), rng.choice(known), new))
            known = sorted({*known, new})
        lists = [rng.choices(range(4), k=rng.randrange(12)) for _ in range(400)] + [[0] * 301]
        got, sizes = bpe.PieceMerger(np.array(merges, np.int64).reshape(-1, 4))(
            np.array([i for ids in lists for i in ids], np.int32), np.array([len(ids) for ids in lists]))
        assert [ids.tolist() for ids in np.split(got, np.cumsum(sizes)[:-1])] == [one_piece(ids, merges) for ids in lists]


def test_new_pieces_are_merged_together(spark, monkeypatch):
    """A batch hands all its new pieces to one call, and pieces beyond the bound are encoded again."""
    calls = []

    def encode(pieces):
        calls.append(pieces.to_pylist())
        return np.array([len(p) for p in pieces.to_pylist()], np.int32), np.ones(len(pieces), np.int64)

    monkeypatch.setattr(codec, "MEMO_PIECES", 2)
    memo = codec._Memo({"<s>": 7}, encode)
    for batch, want in ((["a", "<s>", "bb"], [1, 7, 2]), (["bb", "ccc", "dddd"], [2, 3, 4]), (["ccc", "a"], [3, 1])):
        at, ids, starts = memo.coded(pa.array(batch))
        assert ids[starts[at]].tolist() == want
    assert calls == [["a", "bb"], ["ccc", "dddd"], ["ccc"]]


def test_linked_merges_equal_merges_one_after_the_other():
    """The same words and the same changes of every pair, also where a pair comes twice or symbols come again."""
    rng = random.Random(3)
    for trial in range(60):
        words = ["".join(rng.choices("abc", weights=(4, 2, 1), k=rng.randrange(1, 14))) for _ in range(60)]
        codes, weights = bpe.lay(pa.array(words), pa.array([rng.randrange(1, 9) for _ in words], pa.int64()))
        known, steps = list("abc"), []
        for k in range(rng.randrange(12)):
            made = rng.choice(known) if rng.random() < 0.1 else chr(0x100 + k)
            steps.append((rng.choice(known) + rng.choice(known), made))
            known = [*known, made]
        silent = rng.randrange(len(steps) + 1)
        got_codes, got_weights, got = bpe.merge_steps(codes, weights, steps, silent)
        want = []
        for pair, made in steps:
            codes, weights, *change = bpe.merge_laid(codes, weights, pair, made)
            want.append({k: n for k, n in zip(*map(np.ndarray.tolist, change)) if n})
        assert got_codes.tolist() == codes.tolist() and got_weights.tolist() == weights.tolist()
        assert [{k: n for k, n in zip(*map(np.ndarray.tolist, change)) if n} for change in got] == want[silent:]


def test_a_step_costs_what_it_merges(monkeypatch):
    """No pass over all words for each merge."""
    codes, weights = bpe.lay(pa.array(["abcabc"] * 1000), pa.array([1] * 1000, pa.int64()))
    monkeypatch.setattr(bpe, "merge_laid", None)
    steps = [("ab", "Ā"), ("Āc", "ā"), ("āā", "Ă")]
    got, _, found = bpe.merge_steps(codes, weights, steps, 0)
    assert got[got > 0].tolist() == [0x102] * 1000 and len(found) == 3


def test_many_pairs_are_not_searched_one_by_one(spark, monkeypatch):
    """Beyond a number of pairs every word is laid out; the changes are the same."""
    sought, contains = [], F.contains
    monkeypatch.setattr(bpe.F, "contains", lambda word, s: sought.append(s) or contains(word, s))
    words = spark.createDataFrame([("abcabc", 5), ("cab", 7), ("bbbb", 2), ("xyz", 9)], "word string, n bigint")
    state = bpe.Words(words)
    try:
        steps = [("ab", "Ā"), ("Āc", "ā"), ("bb", "Ă")]
        few = state.changes(steps)
        assert len(sought) == 3
        monkeypatch.setattr(bpe, "MOST_SOUGHT", 2)
        assert state.changes(steps) == few and len(sought) == 3 and all(few)
    finally:
        state.drop()
