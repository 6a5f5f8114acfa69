"""Label alignment, spans and scores."""

import pytest

from tokenloom.functions.labels import argmax, map_labels
from tokenloom.operators import bpe, tagging
from tokenloom.plans.tagging import evaluate, tagging_dataset
from pyspark.sql import functions as F


def tagged(spark, rows):
    return spark.createDataFrame(
        [(i, t, n) for i, (t, n) in enumerate(rows)],
        "sent_id bigint, token array<string>, ner array<string>")


def test_first_token_of_a_word_carries_the_label(spark):
    df = tagged(spark, [(["Ana", "", "ide."], ["B-PERS", "O", "X"]), ([], [])])
    rows = tagging.align_labels(df, bpe.byte_tokenizer(spark)).orderBy("sent_id").collect()
    assert rows[0].input_ids[0] == 0 and rows[0].input_ids[-1] == 2
    assert rows[0].labels == [-100, 1, -100, -100, -100, -100, -100, -100, -100, -100, -100]
    assert (rows[1].input_ids, rows[1].labels) == ([0, 2], [-100, -100])
    cut = tagging.align_labels(df, bpe.byte_tokenizer(spark), max_len=4).orderBy("sent_id").first()
    assert len(cut.input_ids) == 4 and cut.input_ids[-1] == 2


def test_dataset_keeps_only_new_columns(spark):
    df = tagged(spark, [(["a", "b"], ["O", "B-LOC"])] * 20)
    out = tagging_dataset(df, bpe.byte_tokenizer(spark))
    assert sorted(out.columns) == ["input_ids", "labels", "sent_id", "split"]
    assert out.filter("split = 'test'").count() == 2


@pytest.mark.parametrize("tags,want", [
    ("", []),
    ("O O", []),
    ("B-A I-A O", [("A", 0, 1)]),
    ("I-A I-A", [("A", 0, 1)]),
    ("O I-A B-A", [("A", 1, 1), ("A", 2, 2)]),
    ("B-A I-B I-B", [("A", 0, 0), ("B", 1, 2)]),
    ("B-A B-A I-A O I-B", [("A", 0, 0), ("A", 1, 2), ("B", 4, 4)]),
])
def test_spans(spark, tags, want):
    df = spark.createDataFrame([(1, tags.split())], "sent_id int, true_tags array<string>")
    rows = tagging.entity_spans(df).collect()
    assert [(r.type, r.start, r.end) for r in rows] == want


def test_scores(spark):
    df = spark.createDataFrame([
        (1, "B-A I-A O B-B".split(), "B-A I-A O B-A".split()),
        (2, "O O".split(), "B-A O".split()),
    ], "sent_id int, pred_tags array<string>, true_tags array<string>")
    r = tagging.span_scores(df).first()
    assert (r.precision, r.recall) == (1 / 2, 1 / 3)
    assert r.f1 == pytest.approx(0.4) and r.accuracy == 4 / 6
    none = tagging.span_scores(df.filter("sent_id = 9")).first()
    assert (none.precision, none.recall, none.f1, none.accuracy) == (0, 0, 0, 0)


def test_evaluate_skips_ignored_positions(spark):
    rows = [(1, 0, [0.1, 0.9, 0.0], 1), (1, 1, [9.0, 0.0, 0.0], -100), (1, 2, [0.9, 0.9, 0.0], 0)]
    df = spark.createDataFrame(rows, "sent_id int, pos int, logits array<double>, label int")
    labels = {"O": 0, "B-A": 1, "I-A": 2}
    r = evaluate(df, labels).first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == (1, 1, 1, 1)


def test_columns(spark):
    df = spark.createDataFrame([([0.5, 2.0, 2.0], ["O", "nope"])], "s array<double>, l array<string>")
    r = df.select(argmax(F.col("s")).alias("a"), map_labels(F.col("l")).alias("m")).first()
    assert r.a == 1 and r.m == [14, -100]
