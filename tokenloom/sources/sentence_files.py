"""Files that hold one JSON object with a list of sentences.

A file of at most ``WHOLE_BYTES`` is one row, which is parsed where it lies, without a shuffle. A larger one is shared between
tasks: it is read cut at its quotes, so its splits go to different tasks. A quote is escaped when an odd
number of backslashes stands before it; the number of true quotes before a record, a prefix sum over the
file, tells whether the record lies in a string, and the running sum of opened and closed brackets how deep.
Sentences are decoded where they lie. What stands around the list is put together, one small row per
file, and must be one whole JSON object.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import with_offsets
from ..session import scratch_path
from .files import MAX_SPLITS, file_label, numbered_lines, require_files

WHOLE_BYTES = 8 << 20  # of a file that one task parses whole
BATCH_SENTENCES = 10_000
_SPACE = "[ \\t\\n\\r]*"


def _key(df: DataFrame) -> Column:
    """Label and path: files with one label in a partitioned folder are objects of their own."""
    return F.concat(file_label(df, join_parts=False), F.lit("\n"), F.col("_metadata.file_path"))


def _label(key: Column) -> Column:
    return F.substring_index(key, "\n", 1)


def _tokens(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file, k, text)``: what stands between true quotes, as a written table; odd ``k`` are strings as they were written."""
    lines = spark.read.option("lineSep", '"').text(paths).where(F.col("_metadata.file_size") > WHOLE_BYTES)
    records = numbered_lines(lines.withColumn("file", _key(lines))).select("file", "line", "value")
    backslashes = F.length("value") - F.length(F.rtrim("value", F.lit("\\")))
    counted = with_offsets(records, "file", "line", (backslashes % 2 == 0).cast("int"), "k")
    parts = F.sort_array(F.collect_list(F.struct("line", "value")))
    path = scratch_path(spark, "sentence-tokens")
    counted.groupBy("file", "k").agg(parts.alias("parts")).select(
        "file", "k", F.array_join(F.transform("parts", lambda p: p["value"]), '"').alias("text")).write.parquet(path)
    return spark.read.parquet(path)


def _decoded(text: Column) -> Column:
    """The string that stands for ``text`` in JSON, null where it is not well formed."""
    escaped = F.from_json(F.concat(F.lit('["'), text, F.lit('"]')), "array<string>")
    return F.when(text.rlike(r"[\\\x00-\x1f]"), F.get(escaped, F.lit(0))).otherwise(text)


def _occurrences(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _around_list(attr: str):
    """Whether a file's text without the sentences is one object whose ``attr`` is a list."""
    @F.pandas_udf("boolean")
    def whole(texts: pd.Series) -> pd.Series:
        def one(text: str) -> bool:
            try:
                found = json.loads(text)
            except (ValueError, RecursionError):
                return False
            return isinstance(found, dict) and found.get(attr) == []
        return texts.map(one)
    return whole


def _sentences(content: bytes, attr: str) -> list[str] | None:
    """The list of a whole file, nothing where it is not one JSON object with a list of strings.

    Half a surrogate pair becomes a question mark, and broken UTF-8 U+FFFD.
    """
    try:
        found = json.loads(content.decode(errors="replace"))
    except (ValueError, RecursionError):
        return None
    sents = found.get(attr) if isinstance(found, dict) else None
    if not isinstance(sents, list) or not all(isinstance(sent, str) for sent in sents):
        return None
    return [sent if sent.isascii() else sent.encode(errors="replace").decode() for sent in sents]


def _parsed(attr: str) -> Callable:
    """``(file, content)`` -> ``(file, pos, sent)`` of the good files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file"), batch.column("content")):
                sents = _sentences(content.as_py(), attr) or []
                for start in range(0, len(sents), BATCH_SENTENCES):
                    part = pa.array(sents[start:start + BATCH_SENTENCES], pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(name, len(part)), pa.array(range(start, start + len(part)), pa.int32()), part], ["file", "pos", "sent"])
    return run


def _judged(attr: str) -> Callable:
    """``(file, content)`` -> ``(file, ok, sentences)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_sentences(content.as_py(), attr) for content in batch.column("content")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), pa.array([f is not None for f in found], pa.bool_()), pa.array([len(f or ()) for f in found], pa.int64())],
                ["file", "ok", "sentences"])
    return run


def _bounds(tokens: DataFrame, attr: str) -> DataFrame:
    """``(file, start, end)``: the tokens that open and close the list of files that have one.

    All but the strings equal to ``attr`` are counts and places. Of several lists of that name in the outer
    object the last counts.
    """
    text = F.col("text")
    signs = tokens.where("k % 2 = 0").select(
        "file", "k", (_occurrences(text, "{[") - _occurrences(text, "}]")).alias("delta"),
        text.rlike(f"^{_SPACE}:{_SPACE}\\[").alias("opens"))
    signs = with_offsets(signs, "file", "k", F.col("delta"), "depth")
    names = tokens.where("k % 2 = 1").where(_decoded(text) == attr).select("file", (F.col("k") + 1).alias("k"))
    starts = signs.where("opens and depth = 1").join(names, ["file", "k"]).groupBy("file").agg(F.max("k").alias("start"))
    return signs.where("depth + delta <= 1").join(starts, "file").where("k >= start").groupBy("file").agg(
        F.first("start").alias("start"), F.min("k").alias("end"))


def read_sentence_files(spark: SparkSession, paths: str | Sequence[str], attr: str) -> tuple[DataFrame, DataFrame]:
    """``sents(file, pos, sent)`` of the good files, and ``verdicts(file, ok, sentences)`` with a row for each file.

    A good file is one JSON object, with nothing but white space after it, in which ``attr`` is a list of strings; an empty list is
    good. A cut file, trailing text and a list that holds anything else are not. Spark passes over files of
    no bytes, which are in neither result. A single sentence, and all that stands outside the list, must fit one task.
    """
    listed = require_files(spark, paths)
    files = spark.read.format("binaryFile").load(listed)
    whole = files.where(F.col("length") <= WHOLE_BYTES).select(file_label(files, join_parts=False).alias("file"), "content")
    sents = whole.mapInArrow(_parsed(attr), "file string, pos int, sent string")
    verdicts = whole.mapInArrow(_judged(attr), "file string, ok boolean, sentences bigint")
    large = files.where(F.col("length") > WHOLE_BYTES)
    if large.select("path").isEmpty():
        return sents, verdicts
    large_sents, large_verdicts = _read_shared(spark, listed, large, attr)
    return sents.unionByName(large_sents), verdicts.unionByName(large_verdicts)


def _read_shared(spark: SparkSession, listed: list[str], files: DataFrame, attr: str) -> tuple[DataFrame, DataFrame]:
    """The results of the large files among the listed ones."""
    tokens = _tokens(spark, listed)
    bounds_path, verdicts_path = (scratch_path(spark, name) for name in ("sentence-bounds", "sentence-verdicts"))
    _bounds(tokens, attr).write.parquet(bounds_path)
    bounds = spark.read.parquet(bounds_path)
    if bounds.count() > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} sentence files at a time")
    placed = tokens.join(F.broadcast(bounds), "file")
    k, text = F.col("k"), F.col("text")

    def matches(pattern: str) -> Column:
        return text.rlike(pattern.replace(" ", _SPACE))

    at_start, at_end, in_list = k == F.col("start"), k == F.col("end"), (k > F.col("start")) & (k < F.col("end"))
    string = in_list & (k % 2 == 1)
    fits = F.when(at_start & at_end, matches("^ : \\[ \\]")).when(at_start, matches("^ : \\[ $")).when(at_end, matches("^ \\]")) \
        .when(string, _decoded(text).isNotNull()).when(in_list, matches("^ , $")).otherwise(True)
    part = F.when(~in_list, F.struct("k", "text"))

    def joined(which) -> Column:
        return F.array_join(F.transform(F.filter("parts", which), lambda p: p["text"]), '"')

    start, end = F.col("start"), F.col("end")
    around = F.concat(joined(lambda p: p["k"] <= start), joined(lambda p: (p["k"] >= end) & (p["k"] > start)))
    checked = placed.groupBy("file", "start", "end").agg(
        F.bool_and(fits).alias("fits"), F.sum(string.cast("bigint")).alias("sentences"),
        F.sort_array(F.collect_list(part)).alias("parts"))
    checked.select("file", (F.col("fits") & _around_list(attr)(around)).alias("ok"), "sentences").write.parquet(verdicts_path)
    verdicts = spark.read.parquet(verdicts_path)
    good = bounds.join(verdicts.where("ok"), "file")
    sents = tokens.join(F.broadcast(good.select("file", "start", "end")), "file").where(string).select(
        _label(F.col("file")).alias("file"), ((k - start - 1) / 2).cast("int").alias("pos"), F.make_valid_utf8(_decoded(text)).alias("sent"))
    each = files.select(_key(files).alias("file")).join(verdicts, "file", "left").select(
        _label(F.col("file")).alias("file"), F.coalesce("ok", F.lit(False)).alias("ok"), F.when(F.col("ok"), F.col("sentences")).otherwise(0).alias("sentences"))
    return sents, each
