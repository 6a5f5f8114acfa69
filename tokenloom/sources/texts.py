"""Text corpora in JSON and JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import numbered_lines, require_files
from .sentence_files import read_sentence_files


def read_jsonl_attr(spark: SparkSession, paths: str | Sequence[str],
                    attr: str = "text") -> DataFrame:
    """``corpus(file, doc_id, text)`` from one JSON object per line.

    The declared schema holds the one wanted attribute, so the parser skips the rest. A
    line that is not JSON, or lacks the attribute, fails the job. ``doc_id`` is the number
    of the line in its file.
    """
    schema = T.StructType([T.StructField(attr, T.StringType())])
    lines = numbered_lines(spark.read.text(require_files(spark, paths)))
    missing = F.raise_error(F.lit(f"a line has no attribute {attr!r}")).cast("string")
    text = F.from_json("value", schema, {"mode": "FAILFAST"})[attr]
    return lines.select("file", F.col("line").alias("doc_id"), F.coalesce(text, missing).alias("text"))


def read_json_list_attr(spark: SparkSession, paths: str | Sequence[str],
                        attr: str = "sents") -> DataFrame:
    """``sents(file, pos, sent)`` from one JSON object per file with a list of strings; any other file fails the job."""
    sents, verdicts = read_sentence_files(spark, paths, attr)
    broken = verdicts.where(~F.col("ok")).select("file").first()
    if broken is not None:
        raise ValueError(f"no list {attr!r} in file {broken.file}")
    return sents


def read_tolerant(spark: SparkSession, paths: str | Sequence[str],
                  attr: str = "sents") -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``read_json_list_attr``, but files that fail are set aside.

    Returns the sentences, ``rejects(file)``, and ``report(files, sentences)`` where
    ``files`` counts every file and ``sentences`` those of the good ones.
    """
    sents, verdicts = read_sentence_files(spark, paths, attr)
    report = verdicts.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("sentences"), F.lit(0)).cast("bigint").alias("sentences"))
    return sents, verdicts.where(~F.col("ok")).select("file"), report


def read_labelled(spark: SparkSession, paths: str | Sequence[str], token_col: str = "token",
                  label_col: str = "ner") -> DataFrame:
    """``tagged(sent_id, token, ner)`` from JSON lines with parallel lists.

    ``sent_id`` numbers the lines over all files. A line without both lists, or with lists of different lengths,
    fails the job.
    """
    strings = T.ArrayType(T.StringType())
    schema = T.StructType([T.StructField(token_col, strings), T.StructField(label_col, strings)])
    lines = numbered_lines(spark.read.text(require_files(spark, paths)), per_file=False)
    row = F.from_json("value", schema, {"mode": "FAILFAST"})
    rows = lines.select(F.col("line").alias("sent_id"), row.alias("row")).select(
        "sent_id", F.col("row")[token_col].alias(token_col), F.col("row")[label_col].alias(label_col))
    uneven = F.raise_error(F.concat(F.lit("no parallel lists in line "), F.col("sent_id").cast("string")))
    parallel = F.size(token_col) == F.size(label_col)
    return rows.withColumn(label_col, F.when(parallel, F.col(label_col)).otherwise(uneven.cast("array<string>")))


def append_sample_log(rows: DataFrame, path: str, column: str = "samples") -> None:
    """Append one tab-joined line per row; lists of lists are flattened first."""
    strings = F.col(column)
    if isinstance(rows.schema[column].dataType.elementType, T.ArrayType):
        strings = F.flatten(strings)
    rows.select(F.concat_ws("\t", strings).alias("value")).write.mode("append").text(path)
