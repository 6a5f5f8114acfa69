"""Near duplicates: hot groups against brute force, several texts under one id, the exact prefix filter."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import minhash

DOCS = "doc_id bigint, text string, node string, label string"


def shingles(text, width=3):
    words = (text or "").lower().split()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent=85):
    """The smallest id reachable from each id."""
    sets = {i: shingles(t) for i, t, *_ in rows}
    low = {i: i for i in sets}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            low[b] = a
    return {i: find(i) for i in sets}


def families(seed, groups, size, words, edits):
    """Texts that change some words of their group's first text."""
    draw = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(draw.choice(edits)):
                text[draw.randrange(words)] = f"x{draw.randrange(10 ** 9)}"
            rows.append((len(rows), " ".join(text), None, "x"))
    return rows


@pytest.mark.parametrize("groups,size,words,edits", [
    (1, 160, 80, [0, 1, 2, 3, 4, 5, 6, 8]),  # a core with a fringe of texts that link to nothing
    (1, 120, 60, [6, 7, 8]),  # pages of one template, 0.5 to 0.8 alike
    (6, 30, 40, [0, 1, 2, 3]), (2, 60, 12, [0, 0, 1, 2]),
])
def test_hot_groups_equal_brute_force(spark, groups, size, words, edits):
    rows = families(3, groups, size, words, edits)
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOCS), width=3, percent=85).collect()
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (want[r.doc_id] == r.doc_id) for r in got)


def test_prefix_lists_bring_every_near_pair_together(spark):
    """Pairs at or above the threshold share a list with the classes of both; template pages share none."""
    near, pages = families(5, 1, 40, 50, [0, 1, 2, 3]), families(6, 1, 40, 60, [7, 8])
    for rows, pairs_expected in ((near, True), (pages, False)):
        sets = spark.createDataFrame([(bytes([i]), sorted(hash(s) >> 1 for s in shingles(t))) for i, t, *_ in rows],
                                     "digest binary, items array<bigint>")
        texts = sets.select(F.struct(F.lit(0).cast("bigint").alias("id"), "digest").alias("node"), F.lit(1).alias("score"),
                            F.col("digest").alias("label"))
        lists = minhash.prefix_lists(texts, sets, 85).select("token", "low", "high", "class", F.col("node.digest").alias("d"))
        other = lists.select("token", "low", "high", F.col("class").alias("class2"), F.col("d").alias("d2"))
        met = {(r.d[0], r.d2[0]) for r in lists.join(other, ["token", "low", "high"]).where(
            "d < d2 and class + class2 = low + high").select("d", "d2").collect()}
        own = [shingles(t) for _, t, *_ in rows]
        near_pairs = {(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if 100 * len(own[a] & own[b]) >= 85 * len(own[a] | own[b])}
        assert near_pairs <= met and bool(near_pairs) == pairs_expected
        if not pairs_expected:
            assert len(met) < len(rows) ** 2 / 20


def test_several_texts_under_one_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(5, a, "x", None), (5, b, None, "y"), (6, a + " end", None, None), (7, b + " end", None, None), (5, a, None, None),
            (5, a.upper(), None, None), (5, a + " more", None, None), (5, "", None, None), (5, None, None, None), (None, a, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == sorted([(5, 56, 5, True)] * 4 + [(5, 57, 5, True), (6, 57, 5, False), (7, 57, 5, False)]
                         + [(5, 0, 5, True)] * 2 + [(0, 56, 5, False)])
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    texts = [(r.doc_id, (r.text or "").lower()) for r in kept.collect()]
    # One text of the group of ``a``, ``b``, one without words, and the row without an id.
    assert len(texts) == 4 and {(5, b), (5, ""), (None, a)} <= set(texts)
    assert any(t in ((5, a), (5, a + " more")) for t in texts)
