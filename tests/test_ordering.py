"""Shuffles, positions and splits."""

import hashlib
import io
import re
from contextlib import redirect_stdout

import pytest

from tokenloom.operators import batches, ordering, packing


def examples(spark, n, per_doc=3):
    rows = [(f"f{(i // per_doc) % 4}", i // per_doc, i % per_doc, [i]) for i in range(n)]
    return spark.createDataFrame(rows, "file string, doc_id bigint, ex_idx int, ids array<int>")


def by_hash(row, seed=0):
    key = f"{seed}:{row.file}:{row.doc_id}:{row.ex_idx}"
    return hashlib.md5(key.encode()).hexdigest()


def test_shuffle_is_a_seeded_permutation(spark):
    df = examples(spark, 500)
    for seed in (0, 7):
        rows = sorted(ordering.shuffle_rows(df, seed=seed).collect(), key=lambda r: r.pos)
        assert [r.pos for r in rows] == list(range(500))
        assert [by_hash(r, seed) for r in rows] == sorted(by_hash(r, seed) for r in rows)


def test_file_orders(spark):
    df = examples(spark, 300)
    plain = sorted(ordering.file_positions(df).collect(), key=lambda r: r.pos)
    assert [r.pos for r in plain] == list(range(300))
    assert plain == sorted(plain, key=lambda r: (r.file, r.doc_id, r.ex_idx))
    mixed = sorted(ordering.shuffle_files(df).collect(), key=lambda r: r.pos)
    order = list(dict.fromkeys(r.file for r in mixed))
    assert len(order) == 4
    assert order == sorted(order, key=lambda f: hashlib.md5(f"0:{f}".encode()).hexdigest())
    for f in order:
        part = [(r.doc_id, r.ex_idx) for r in mixed if r.file == f]
        assert part == sorted(part)


@pytest.mark.parametrize("n,dev", [(0, 0), (10, 0), (50, 0), (150, 2), (250, 2), (350, 4)])
@pytest.mark.parametrize("shuffle", [False, True])
def test_split_rounds_half_to_even(spark, n, dev, shuffle):
    rows = ordering.split_head(examples(spark, n), shuffle=shuffle).collect()
    assert len(rows) == n
    order = by_hash if shuffle else (lambda r: (r.file, r.doc_id, r.ex_idx))
    rows.sort(key=order)
    assert [r.split for r in rows] == ["dev"] * dev + ["train"] * (n - dev)
    assert "_range" not in (rows[0].asDict() if rows else {})


@pytest.mark.parametrize("ratio", [0.0, 0.5, 1.0])
def test_split_extremes(spark, ratio):
    rows = ordering.split_head(examples(spark, 9), ratio).collect()
    assert sum(r.split == "dev" for r in rows) == round(9 * ratio)


def test_shuffle_and_split_agree(spark):
    df = examples(spark, 350)
    one = {(r.doc_id, r.ex_idx): r.split for r in ordering.shuffle_and_split(df).collect()}
    two = {(r.doc_id, r.ex_idx): r.split
           for r in ordering.split_head(df, shuffle=True).collect()}
    assert one == two


def test_split_fraction_takes_the_ceiling(spark):
    df = spark.range(41).withColumnRenamed("id", "sent_id")
    rows = ordering.split_fraction(df).collect()
    assert sum(r.split == "test" for r in rows) == 5


def test_hot_file_is_spread(spark):
    """The heavy windows are keyed by key range, not by file alone."""
    plan = ordering.file_positions(examples(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_file" in plan and "_range" in plan


def shuffles_of_ids(make):
    """How many exchanges carry token ids in the plan for tables too large to broadcast."""
    text = io.StringIO()
    df = make()
    conf, name = df.sparkSession.conf, "spark.sql.autoBroadcastJoinThreshold"
    before = conf.get(name)
    conf.set(name, "-1")
    try:
        with redirect_stdout(text):
            make().explain("formatted")
    finally:
        conf.set(name, before)
    exchanges = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text.getvalue())
    assert exchanges
    return sum(bool(re.search(r"\bids#", x)) for x in exchanges)


@pytest.mark.parametrize("place", [ordering.file_positions, ordering.shuffle_files, ordering.shuffle_rows])
def test_batches_move_the_ids_once(spark, place):
    rows = [(f"f{i % 3}" if i % 7 else None, i, 0, list(range(i % 11))) for i in range(200)]
    df = spark.createDataFrame(rows, "file string, doc_id bigint, ex_idx int, ids array<int>")
    assert shuffles_of_ids(lambda: batches.ordered_batches(df, place, ordering.EXAMPLE_KEYS)) == 1
    got = batches.ordered_batches(df, place, ordering.EXAMPLE_KEYS)
    want = batches.batch_pad(place(df))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert batches.ordered_batches(df.limit(0), place, ordering.EXAMPLE_KEYS).count() == 0


def test_chunks_need_one_shuffle_of_whole_lists(spark):
    df = spark.createDataFrame([("f", i, list(range(5))) for i in range(50)], "file string, doc_id bigint, ids array<int>")
    placed = ordering.with_offsets(df, "file", "doc_id", packing.F.size("ids"), "at")
    assert shuffles_of_ids(lambda: ordering.with_offsets(df, "file", "doc_id", packing.F.size("ids"), "at")) == 1
    assert {r.doc_id: r.at for r in placed.collect()} == {i: 5 * i for i in range(50)}


def test_a_null_file_stays_null_and_comes_first(spark):
    rows = [(f, i, 0, [i]) for f in (None, "", "a") for i in range(3)]
    df = spark.createDataFrame(rows, "file string, doc_id bigint, ex_idx int, ids array<int>")
    placed = sorted(ordering.file_positions(df).collect(), key=lambda r: r.pos)
    assert [(r.file, r.doc_id) for r in placed] == [r[:2] for r in rows]
    heads = {(r.file, r.doc_id) for r in ordering.split_head(df, 0.5).collect() if r.split == "dev"}
    assert heads == {r[:2] for r in rows[:4]}
    chunks = {(r.file, r.chunk_idx): r.ids for r in packing.chunk_block(df, 2).collect()}
    assert chunks == {(f, c): ids for f in (None, "", "a") for c, ids in ((0, [0, 1]), (1, [2]))}


def in_partitions(df, *order):
    got = df.sortWithinPartitions(*order).rdd.mapPartitionsWithIndex(lambda i, rows: ((i, r) for r in rows)).collect()
    return [r for _, r in got], len({i for i, _ in got})


def test_parts_follow_the_file_order(spark):
    """A hot file, sparse and null keys, long rows: all spread over parts that follow one another."""
    rows = [("hot", i * 10**12 if i % 2 else i, k, [0] * (i % 9)) for i in range(400) for k in range(2)]
    rows += [(f"f{i % 5}", -i, 0, [1]) for i in range(100)] + [(None, None, 0, [1]), ("f1", None, 0, None)]
    df = spark.createDataFrame(rows, "file string, doc_id bigint, ex_idx int, ids array<int>")
    keys = ordering.EXAMPLE_KEYS
    got, used = in_partitions(ordering.file_parts(df, keys, parts=13), *keys)
    assert used == 13 and len(got) == len(rows)
    place = {tuple(r[:3]): i for i, r in enumerate(df.orderBy(*keys).collect())}
    order = [place[tuple(r[:3])] for r in got if r.doc_id is not None]
    assert order == sorted(order)
    assert shuffles_of_ids(lambda: ordering.file_parts(df, keys, parts=13)) == 1
    assert ordering.file_parts(df.limit(0), keys).count() == 0


def test_parts_follow_the_seeded_order(spark):
    df = examples(spark, 300)
    for seed in (0, 5):
        got, used = in_partitions(ordering.seeded_parts(df, seed=seed, parts=7), "shuffle_key", *ordering.EXAMPLE_KEYS)
        assert used == 7
        want = sorted(ordering.shuffle_rows(df, seed=seed).collect(), key=lambda r: r.pos)
        assert [r.ids for r in got] == [r.ids for r in want]
    assert shuffles_of_ids(lambda: ordering.seeded_parts(df)) == 1


def test_examples_of_a_written_split_are_made_once(spark, monkeypatch):
    from tokenloom.catalog import queries

    made = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(f"f{i % 3}", i, 0, [i, 2]) for i in range(40)], "file string, doc_id bigint, ex_idx int, ids array<int>")

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(queries.inputs, "examples", lambda *_: rows.mapInArrow(counted, rows.schema))
    assert queries.write_split(spark, "").count() == 40
    assert made.value == 40
