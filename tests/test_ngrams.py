"""N-gram statistics against brute force."""

from collections import Counter

import pytest

from tokenloom.operators import ngrams

DOCS = [[1, 2, 3, 1, 2, 3, 1, 2], [5, 5, 5, 5], [], [9], [1, 2], [1, 2, 3, 4]]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "doc_id bigint, ids array<int>")


def test_repeated(df):
    got = {(r.doc_id, tuple(r.gram)): r.n for r in ngrams.repeated_ngrams(df).collect()}
    want = {}
    for d, ids in enumerate(DOCS):
        counts = Counter(zip(ids, ids[1:], ids[2:]))
        want.update({(d, g): n for g, n in counts.items() if n > 1})
    assert got == want


def test_fill_slot(df):
    counts = Counter(g for ids in DOCS for g in zip(ids, ids[1:], ids[2:]))
    rows = ngrams.fill_slot_topk(df, k=1).collect()
    assert {(r.prev, r.mid, r.next): r.n for r in rows} == dict(counts)


def test_distribution_sums_to_one(df):
    totals = Counter()
    for r in ngrams.next_token_distribution(df).collect():
        totals[r.prev] += r.p
    assert all(abs(p - 1) < 1e-12 for p in totals.values())


def test_samples_follow_the_distribution(spark):
    df = spark.createDataFrame([(i, [1, 2] if i % 4 else [1, 3]) for i in range(400)],
                               "doc_id bigint, ids array<int>")
    rows = ngrams.sample_next(df, n=400, temp=1.0).collect()
    share = sum(r.next == 2 for r in rows) / len(rows)
    assert abs(share - 0.75) < 0.08
    again = ngrams.sample_next(df, n=400, temp=1.0).collect()
    assert sorted(rows) == sorted(again)


def test_word_ids_equal_the_column_formula(spark, monkeypatch):
    """Null, empty and blank texts, runs of spaces and other white space; one worker remembers only a few words."""
    from pyspark.sql import functions as F

    from tokenloom.catalog import inputs
    from tokenloom.functions.hashing import hash_int

    monkeypatch.setattr(inputs, "MEMO_WORDS", 3)
    texts = [None, "", " ", "\n", "a  b\n\nb a ", "\t\u00a0x é\r\n漢", "a b c d e f g a\n" * 50]
    rows = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "file string, doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(inputs, "corpus", lambda *_: rows)
    words = F.transform(F.split("text", "\n"), lambda x: F.concat(F.transform(
        F.filter(F.split(x, " "), lambda w: w != ""), lambda w: (hash_int(F.md5(w), 0) % inputs.WORD_IDS + 5).cast("int")), F.array(F.lit(2))))
    found = inputs.encoded(spark, "")
    assert found.collect() == rows.select("file", "doc_id", F.flatten(words).alias("ids")).collect()
    assert "conv(" not in found._jdf.queryExecution().optimizedPlan().toString()  # no hash of each word as a string expression
