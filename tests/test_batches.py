"""Padding and masking."""


import pytest

from tokenloom.constants import IGNORE_LABEL
from tokenloom.operators import batches, ordering
from tokenloom.plans.pretraining import batches_of_files, training_batches
from tokenloom.sources import tokens


def frame(spark, lists):
    rows = [("f", i, 0, i, x) for i, x in enumerate(lists)]
    return spark.createDataFrame(
        rows, "file string, doc_id bigint, ex_idx int, pos bigint, ids array<int>")


KEYS = ("file", "doc_id", "ex_idx")


def test_batch_pad(spark):
    rows = batches.clm_labels(batches.batch_pad(frame(spark, [[7], [8, 9], [5, 6, 7]]), 2)).collect()
    got = {(r.batch_id, r.row): (r.input_ids, r.attention_mask, r.labels) for r in rows}
    assert got[0, 0] == ([7, 1], [1, 0], [7, IGNORE_LABEL])
    assert got[0, 1] == ([8, 9], [1, 1], [8, 9])
    assert got[1, 0] == ([5, 6, 7], [1, 1, 1], [5, 6, 7])


def test_fit_length(spark):
    rows = batches.fit_length(frame(spark, [[7], [5, 6, 7, 8]]), 3).orderBy("pos").collect()
    assert [(r.ids, r.attention_mask) for r in rows] == [([7, 1, 1], [1, 0, 0]), ([5, 6, 7], [1, 1, 1])]


def test_mlm_rates(spark):
    lists = [[0, *range(5, 205), 2] for _ in range(200)]
    rows = batches.mlm_mask(frame(spark, lists), 1000, KEYS).collect()
    chosen = masked = kept = 0
    for r in rows:
        original = lists[r.doc_id]
        for x, new, label in zip(original, r.input_ids, r.labels):
            if label == IGNORE_LABEL:
                assert new == x
            else:
                assert label == x >= 5
                chosen += 1
                masked += new == 4
                kept += new == x
    assert abs(chosen / 40_000 - 0.15) < 0.01
    assert abs(masked / chosen - 0.8) < 0.03
    assert abs(kept / chosen - 0.1) < 0.03


def test_seed_changes_the_choice(spark):
    df = frame(spark, [list(range(5, 105))])
    one, two, again = (batches.mlm_mask(df, 1000, KEYS, seed=s).first().labels for s in (0, 1, 0))
    assert one == again != two


def test_whole_words_stay_together(spark):
    lists = [[0] + [x for w in range(40) for x in [6, 7, 9][: 1 + w % 3]] + [2] for _ in range(20)]
    rows = batches.whole_word_mask(frame(spark, lists), 1000, KEYS, lambda i: i == 6).collect()
    for r in rows:
        original = lists[r.doc_id]
        budget = max(1, round(len(original) * 0.15))
        hit = [label != IGNORE_LABEL for label in r.labels]
        assert 0 < sum(hit) <= budget
        assert not hit[0] and not hit[-1]
        for i in range(2, len(original) - 1):
            if original[i] != 6:
                assert hit[i] == hit[i - 1]


def test_short_example_gets_one_word(spark):
    r = batches.whole_word_mask(frame(spark, [[6]]), 1000, KEYS, lambda i: i == 6).first()
    assert r.labels == [6]
    empty = batches.whole_word_mask(frame(spark, [[]]), 1000, KEYS, lambda i: i == 6).first()
    assert empty.labels == [] and empty.input_ids == []
    special = batches.whole_word_mask(frame(spark, [[0, 2]]), 1000, KEYS, lambda i: i == 6).first()
    assert special.input_ids == [0, 2]


def test_masking_plan_hashes_each_token_once(spark):
    plan = batches.mlm_mask(frame(spark, [[7]]), 9, KEYS)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("md5(") == 1


def test_whole_words_of_long_examples_reach_the_rate(spark):
    ids = [6 if i % 4 == 0 else 7 + i % 500 for i in range(8000)]
    r = batches.whole_word_mask(frame(spark, [ids]), 1000, KEYS, lambda i: i == 6).first()
    chosen = sum(x != -100 for x in r.labels)
    assert 1197 <= chosen <= 1200


@pytest.mark.parametrize("objective", ["whole_word", "token", "causal"])
def test_epoch_batches(spark, objective):
    """Every example comes once; its ids can be put together from labels and masked ids; seeds give other orders."""
    lists = [list(range(5, 6 + i)) for i in range(21)]
    df = frame(spark, lists).drop("pos")

    def epoch(seed, size=4):
        got = training_batches(df, 1000, KEYS, objective, starts=lambda x: x % 2 == 0, size=size, seed=seed).collect()
        rows = {(r.batch_id, r.row): r for r in got}
        assert sorted(rows) == [divmod(i, size) for i in range(21)]
        plain = []
        for _, r in sorted(rows.items()):
            n = sum(r.attention_mask)
            width = max(sum(o.attention_mask) for o in got if o.batch_id == r.batch_id)
            assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == width
            assert set(r.input_ids[n:]) <= {1} and set(r.labels[n:]) <= {IGNORE_LABEL}
            plain.append([x if y == IGNORE_LABEL else y for x, y in zip(r.input_ids[:n], r.labels[:n])])
        return plain

    first, second = epoch(0), epoch(1)
    assert first != second and sorted(first) == sorted(second) == lists
    assert epoch(None) == lists


def test_batches_of_split_files(spark, tmp_path):
    df = frame(spark, [[5, 6], [7], [8, 9, 10]]).drop("pos")
    tokens.write_split(ordering.split_head(df, 0.0), str(tmp_path / "set"), order_by=KEYS)
    got = batches_of_files(spark, str(tmp_path / "set" / "split=train"), 1000, objective="causal", seed=None, size=2)
    assert [r.input_ids for r in got.orderBy("batch_id", "row").collect()] == [[5, 6], [7, 1], [8, 9, 10]]
    with pytest.raises(ValueError):
        training_batches(df, 1000, KEYS, "none")
    with pytest.raises(ValueError):
        training_batches(df, 1000, KEYS)


def test_word_masks_of_awkward_lists(spark):
    """Null, empty and long lists, null ids, and keys of more than one hash block, against plain Python; no hash is drawn for other tokens."""
    import hashlib
    import random

    rng = random.Random(5)
    long_key = "k" * 80
    rows = [("a", 1, None), ("a", 2, []), ("b", 3, [None, 7, None, 9]), (long_key, 4, [9] * 7), (None, 5, [3, 3]),
            *((rng.choice("ab"), 10 + i, [rng.randrange(30) for _ in range(rng.randrange(1, 90))]) for i in range(40)),
            ("c", 99, [rng.randrange(5, 30) for _ in range(3000)])]
    df = spark.createDataFrame(rows, "file string, doc_id bigint, ids array<int>")
    out = batches.whole_word_mask(df, 1000, ("file", "doc_id"), lambda i: i % 3 != 0)
    assert out.columns == ["file", "doc_id", "input_ids", "labels"]
    assert "md5(" not in out._jdf.queryExecution().toString()
    found = {r.doc_id: (r.input_ids, r.labels) for r in out.collect()}

    def h(*parts):
        return hashlib.md5(":".join(str(p) for p in parts if p is not None).encode()).hexdigest()

    for file, doc, ids in rows:
        if ids is None:
            assert found[doc] == (None, None)
            continue
        special = [x is not None and x < 5 for x in ids]
        starts = [i for i, x in enumerate(ids) if i == 0 or special[i] or special[i - 1] or (x is not None and x % 3 != 0)]
        words = sorted((h(0, file, doc, "w", a), a, b - a) for a, b in zip(starts, [*starts[1:], len(ids)])
                       if ids[a] is not None and not special[a])
        left, hits = max(round(len(ids) * 0.15), 1), set()
        for _, start, length in words:
            if length <= left:
                left -= length
                hits.update(range(start, start + length))
        new, labels = list(ids), [-100] * len(ids)
        for i in hits:
            d, labels[i] = h(0, file, doc, i), ids[i]
            if int(d[8:16], 16) < round(0.8 * 2**32):
                new[i] = 4
            elif int(d[8:16], 16) < round(0.9 * 2**32):
                new[i] = int(d[16:24], 16) % 1000
        assert found[doc] == (new, labels), doc


def test_tokcls_pad_writes_and_moves_what_it_returns_only(spark, monkeypatch):
    rows = [("a", ["x"], ["O"], [0, 300, 2], [-100, 7, -100]), ("b", ["y"], ["O"], [0, 2], [-100, -100]), ("c", None, None, [], []),
            ("d", ["z"], ["O"], [0, 9, 9, 2], None), (None, ["w"], ["O"], [0, 8, 2], [-100, None, -100])]
    aligned = spark.createDataFrame(
        rows, "sent_id string, token array<string>, ner array<string>, input_ids array<int>, labels array<int>")
    kept = []

    def written(df, name, **options):
        kept.append(set(df.columns))
        return df

    monkeypatch.setattr(batches, "written", written)
    key = ("batch_id", "row")
    got = batches.tokcls_pad(aligned, 2, place=ordering.shuffle_rows).sort(*key).collect()
    assert kept == [{"sent_id", "_n", "input_ids", "labels"}]
    plain = batches.ordered_batches(aligned, ordering.shuffle_rows, ["sent_id"], 2, ids="input_ids", labels="labels")
    assert got == plain.sort(*key).collect() and len(got) == 5
