"""Word labels on sub-word pieces, and scores of tagged spans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BOS_ID, EOS_ID, IGNORE_LABEL, NER_LABELS
from ..functions.columns import let
from ..functions.labels import argmax, keep_labelled, map_labels, name_labels
from ..functions.text import pieces_with_specials
from .bpe import Tokenizer
from .codec import piece_encoder


def align_labels(tagged: DataFrame, tok: Tokenizer, words: str = "token", labels: str = "ner",
                 label_ids: Mapping[str, int] = NER_LABELS, max_len: int | None = None,
                 add_special_tokens: bool = True) -> DataFrame:
    """Add ``input_ids`` and ``labels``.

    Each word is encoded with a leading space. Its first token gets the word's label; its
    other tokens and the special tokens get the ignore label. ``max_len`` counts the
    special tokens too.
    """
    nested = F.transform(words, lambda w: pieces_with_specials(w, True, tok.specials))
    # Generators keep the pieces from being cut twice, for the encoder and for the labels.
    bound = tagged.select("*", F.inline(F.array(F.struct(
        nested.alias("_pieces"), map_labels(F.col(labels), label_ids).alias("_word_labels")
    ))))
    encoded = bound.withColumn("_ids", piece_encoder(tok)(F.flatten("_pieces")))

    def head_only(items: Column, label: Column) -> Column:
        return F.transform(items, lambda _, i: F.when(i == 0, label).otherwise(IGNORE_LABEL))

    per_word = F.arrays_zip("_pieces", "_word_labels")
    per_piece = F.flatten(F.transform(
        per_word, lambda z: head_only(z["_pieces"], z["_word_labels"])
    ))
    zipped = F.arrays_zip(F.col("_ids").alias("ids"), per_piece.alias("label"))
    token_labels = F.flatten(F.transform(zipped, lambda z: head_only(z["ids"], z["label"])))
    token_ids = F.flatten("_ids")
    if max_len is not None:
        room = max_len - 2 if add_special_tokens else max_len
        token_ids, token_labels = F.slice(token_ids, 1, room), F.slice(token_labels, 1, room)
    if add_special_tokens:
        edge = F.array(F.lit(IGNORE_LABEL))
        token_ids = F.concat(F.array(F.lit(BOS_ID)), token_ids, F.array(F.lit(EOS_ID)))
        token_labels = F.concat(edge, token_labels, edge)
    return encoded.select(
        *[c for c in tagged.columns], token_ids.alias("input_ids"),
        token_labels.alias("labels" if labels != "labels" else "label_ids"),
    )


def drop_source_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the columns that the source had, e.g. ``tagged.columns`` taken before aligning."""
    return df.drop(*columns)


def sentence_predictions(predictions: DataFrame) -> DataFrame:
    """``(sent_id, pred, label)`` id lists from ``predictions(sent_id, pos, logits, label)``.

    The scores are reduced to their argmax before the shuffle; a group is one sentence.
    """
    rows = predictions.select("sent_id", F.struct(
        "pos", argmax(F.col("logits")).alias("pred"), "label").alias("r"))
    grouped = rows.groupBy("sent_id").agg(F.sort_array(F.collect_list("r")).alias("r"))
    return grouped.select(
        "sent_id",
        F.transform("r", lambda r: r["pred"]).alias("pred"),
        F.transform("r", lambda r: r["label"]).alias("label"),
    )


def drop_ignored(sentences: DataFrame, label_ids: Mapping[str, int] = NER_LABELS) -> DataFrame:
    """``(sent_id, pred_tags, true_tags)``: names at the positions that carry a label."""
    pred, label = F.col("pred"), F.col("label")
    return sentences.select(
        "sent_id",
        name_labels(keep_labelled(pred, label), label_ids).alias("pred_tags"),
        name_labels(keep_labelled(label, label), label_ids).alias("true_tags"),
    )


def spans_of(tags: Column) -> Column:
    """Entity spans of one sentence as array of struct(type, start, end), ends inclusive.

    A span begins at ``B``, or at ``I`` after ``O``, after another type or at the start;
    it lasts while ``I`` of the same type follows.
    """
    def spans(v: Column) -> Column:
        def kind(tag: Column) -> Column:
            return F.substring_index(tag, "-", -1)

        def opens(i: Column) -> Column:
            tag, previous = F.get(v, i), F.coalesce(F.get(v, i - 1), F.lit("O"))
            fresh = tag.startswith("B-") | (previous == "O") | (kind(previous) != kind(tag))
            return (tag != "O") & fresh

        def closes(i: Column) -> Column:
            after = F.get(v, i + 1)
            return (F.get(v, i) != "O") & (after.isNull() | (after == "O") | opens(i + 1))

        every = F.transform(v, lambda _, i: i)
        zipped = F.arrays_zip(
            F.filter(every, opens).alias("start"), F.filter(every, closes).alias("end")
        )
        return F.transform(zipped, lambda z: F.struct(
            kind(F.get(v, z["start"])).alias("type"), z["start"], z["end"]))

    return let(tags, spans)


def entity_spans(df: DataFrame, tags: str = "true_tags", key: str = "sent_id") -> DataFrame:
    """``spans(sent_id, type, start, end)``; needs no shuffle, a sentence is one row."""
    return df.select(key, F.inline(spans_of(F.col(tags))))


def span_scores(sentences: DataFrame) -> DataFrame:
    """Micro precision, recall and F1 on exact spans, and accuracy over all tags.

    Each sentence is reduced to five counts in place, so only sums are shuffled. A zero
    denominator gives 0.
    """
    def names(tags: str) -> Column:
        return F.transform(
            spans_of(F.col(tags)), lambda s: F.concat_ws(":", s["type"], s["start"], s["end"])
        )

    equal = F.filter(F.arrays_zip("pred_tags", "true_tags"),
                     lambda z: z["pred_tags"] == z["true_tags"])
    counts = sentences.select(F.inline(F.array(F.struct(
        names("pred_tags").alias("p"), names("true_tags").alias("t"),
        F.size(equal).alias("equal"), F.size("true_tags").alias("tags"),
    ))))
    sums = counts.agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n)
        for n, c in {
            "correct": F.size(F.array_intersect("p", "t")),
            "predicted": F.size("p"), "expected": F.size("t"),
            "equal": F.col("equal"), "tags": F.col("tags"),
        }.items()
    ])

    def ratio(a: str | Column, b: str | Column) -> Column:
        a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)

    scored = sums.select(
        ratio("correct", "predicted").alias("precision"),
        ratio("correct", "expected").alias("recall"),
        ratio("equal", "tags").alias("accuracy"),
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.select("precision", "recall", ratio(2 * p * r, p + r).alias("f1"), "accuracy")


def format_pairs(df: DataFrame, word: str = "word", entity: str = "entity") -> DataFrame:
    """One tab-separated line per word from parallel word and entity lists."""
    pairs = F.explode(F.arrays_zip(F.col(word).alias("w"), F.col(entity).alias("e")))
    others = [c for c in df.columns if c not in (word, entity)]
    exploded = df.select(*others, pairs.alias("z"))
    return exploded.select(*others, F.concat_ws("\t", "z.w", "z.e").alias("line"))
