"""The operators' input shapes, derived from the given tables."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import NER_LABELS, VOCAB_SIZE
from ..functions.labels import map_labels
from ..functions.md5 import md5_numbered
from ..operators.bpe import Tokenizer, bpe_train, word_counts, wordpiece_train
from ..operators.packing import pack_trim
from ..session import table

WORD_IDS = VOCAB_SIZE - 5
TRAINED_SIZE = 512
WORDPIECE_SIZE = 448
MEMO_WORDS = 500_000  # words whose ids a worker remembers
DOCS_PER_FILE = 1280
SCORES = 15
TAGS = [*NER_LABELS, "B-MISC"]  # the last one is not in the label dictionary


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core where the files have fewer splits than the cluster has cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return _spread(table(spark, sf, "documents"), "doc_id")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(F.col("source").alias("file"), "doc_id", "text")


def spaced_turns(spark: SparkSession, sf: str) -> DataFrame:
    """``(conv_id, turn, text)`` with two or three newlines where the text has one."""
    gap = F.when(F.col("turn") % 2 == 0, "\n\n").otherwise("\n\n\n")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.replace("text", F.lit("\n"), gap).alias("text"))


def marked(spark: SparkSession, sf: str) -> DataFrame:
    """Texts whose lines are wrapped in sentence marks."""
    wrapped = F.transform(
        F.split("text", "\n"), lambda x: F.concat(F.lit("<s>"), x, F.lit("</s>")))
    return corpus(spark, sf).withColumn("text", F.array_join(wrapped, ""))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def _line_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """For each word between spaces the first 8 hex digits of its md5, modulo ``WORD_IDS``, plus 5; 2 after a line.

    A worker remembers the ids of a bounded number of words.
    """
    memo: dict[bytes, int] = {}

    def word_id(word: bytes) -> int:
        found = memo.get(word)
        if found is None:
            found = int.from_bytes(md5(word).digest()[:4], "big") % WORD_IDS + 5
            if len(memo) < MEMO_WORDS:
                memo[word] = found
        return found

    for texts in batches:
        ids, ends = array("i"), [0]
        for value in texts.cast(pa.binary()):
            text = value.as_py()
            for line in () if text is None else text.split(b"\n"):
                ids.extend([word_id(word) for word in line.split(b" ") if word])
                ids.append(2)
            ends.append(len(ids))
        yield pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(np.array(ids, np.int32)), mask=texts.is_null())


def encoded(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """``encoded(file, doc_id, ids)`` without a tokenizer: one id per word, 2 after a line."""
    return corpus(spark, sf).select("file", "doc_id", *extra, _line_ids("text").alias("ids"))


def examples(spark: SparkSession, sf: str, trim: int = 512) -> DataFrame:
    return pack_trim(encoded(spark, sf), trim)


def sentence_files(spark: SparkSession, sf: str) -> DataFrame:
    """``(file, sents)``: the lines of at most ``DOCS_PER_FILE`` documents per file."""
    docs = corpus(spark, sf)
    bucket = F.expr(f"doc_id div {DOCS_PER_FILE}")
    grouped = docs.groupBy(F.concat_ws("_", "file", bucket).alias("file")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", F.split("text", "\n").alias("lines"))))
        .alias("d"))
    return grouped.select("file", F.flatten(F.transform("d", lambda d: d["lines"])).alias("sents"))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """``tagged(sent_id, token, ner)``: one sentence per line, with tags picked by hash.

    ``sent_id`` is the document's id and the number of the line.
    """
    lines = documents(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "words"))
    sents = lines.select(F.concat_ws(":", "doc_id", "line").alias("sent_id"), F.split("words", " ").alias("token"))
    return sents.withColumn("ner", _tags(F.concat_ws(":", "sent_id", F.lit("")), F.size("token")))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _tags(sentence: pa.Array, size: pa.Array) -> pa.Array:
    """One of ``TAGS`` for each word, by ``md5(sent_id:place)``."""
    sizes = size.to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    row = np.repeat(np.arange(len(sizes)), sizes)
    picked = md5_numbered(sentence.cast(pa.binary()).to_pylist(), row, np.arange(len(row)) - ends[row])[0] % len(TAGS)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(TAGS).take(pa.array(picked)))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """``predictions(sent_id, pos, logits, label)`` with scores picked by hash."""
    rows = tagged(spark, sf).select("sent_id", F.posexplode(map_labels(F.col("ner")))
                                    .alias("pos", "label"))
    scored = rows.withColumn("logits", _scores(
        F.concat_ws(":", "sent_id", F.lit("")), F.concat_ws(":", "sent_id", "pos", F.lit("")), "pos", "label"))
    return scored.select("sent_id", "pos", "logits", "label")


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _scores(sentence: pa.Array, place: pa.Array, pos: pa.Array, label: pa.Array) -> pa.Array:
    """15 scores for each place: ``md5(place:k)`` as a number below 1, and 2 more for the label at four places of five."""
    sentences, places = (column.cast(pa.binary()).to_pylist() for column in (sentence, place))
    numbers, labels = (column.to_numpy(zero_copy_only=False) for column in (pos, label))
    each = np.arange(len(places))
    noise = md5_numbered(places, np.repeat(each, SCORES), np.tile(np.arange(SCORES), len(places)))[0] / 4294967296.0
    sure = md5_numbered(sentences, each, numbers)[1] % 10 < 8
    sure &= (labels >= 0) & (labels < SCORES)
    noise.reshape(-1, SCORES)[each[sure], labels[sure]] += 2.0
    return pa.ListArray.from_arrays(pa.array(np.arange(len(places) + 1) * SCORES, pa.int32()), pa.array(noise))


@lru_cache(maxsize=8)
def _trained(app: str, spark: SparkSession, sf: str) -> Tokenizer:
    return bpe_train(word_counts(documents(spark, sf)), TRAINED_SIZE)


def trained(spark: SparkSession, sf: str) -> Tokenizer:
    """A small vocabulary learned from the whole documents table, once per application."""
    return _trained(spark.sparkContext.applicationId, spark, sf)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, line, text)``: every line of the documents."""
    return documents(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))


@lru_cache(maxsize=8)
def _trained_wordpiece(app: str, spark: SparkSession, sf: str) -> Tokenizer:
    return wordpiece_train(lines(spark, sf), size=WORDPIECE_SIZE)


def trained_wordpiece(spark: SparkSession, sf: str) -> Tokenizer:
    """A small vocabulary learned from all lines, once per application."""
    return _trained_wordpiece(spark.sparkContext.applicationId, spark, sf)
