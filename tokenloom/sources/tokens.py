"""Token lists on disk: one JSON array per line, or one array of arrays per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import file_parts
from ..session import scratch_path
from .files import MAX_SPLITS, numbered_lines, require_files

KEYWORD = "encoded"


def _parse_ids(value: Column) -> Column:
    return F.from_json(value, "array<bigint>", {"mode": "FAILFAST"})


def read_token_lists(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``encoded(file, doc_id, ids)`` from one JSON int array per line.

    ``doc_id`` is the number of the line in its file. Several paths are concatenated. Extra partition columns,
    such as ``split``, are kept.
    """
    df = spark.read.text(require_files(spark, paths))
    extra = [c for c in df.columns if c not in ("value", "file")]
    return numbered_lines(df).select(
        "file", F.col("line").alias("doc_id"), _parse_ids(F.col("value")).alias("ids"), *extra)


def read_token_matrix(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``encoded(file, doc_id, ids)`` from files that hold one array of arrays each.

    The file is split at ``]``, so that several tasks share a large one. Each record then holds one list, but for
    the signs that end the file. ``doc_id`` is the number of the list in its file. In a folder ``file=<name>`` each part may hold an
    array of its own, or go on with the array of the part before, as ``write_token_matrix`` leaves them.
    """
    df = spark.read.option("lineSep", "]").text(require_files(spark, paths))
    value = F.col("value")
    lists = numbered_lines(df, value.contains("["))
    # The first record of a file also opens the outer array; what follows the last list holds only its end.
    whole, follows = value.rlike(r"^\s*\[\s*\[[^\[]*$"), value.rlike(r"^\s*,\s*\[[^\[]*$")
    opens = F.when(~F.col("first"), follows).when(F.col("line") == 0, whole).otherwise(whole | follows)
    ends = value.rlike(r"^\s*$") | (F.col("first") & value.rlike(r"^\s*\[\s*$"))
    wrong = F.raise_error(F.concat(F.lit("no array of arrays in file "), F.col("file"))).cast("boolean")
    is_list = F.when(opens, True).when(ends, False).otherwise(wrong)
    body = F.concat(F.lit("["), F.substring_index(value, "[", -1), F.lit("]"))
    return lists.filter(is_list).select(
        "file", F.col("line").alias("doc_id"), _parse_ids(body).alias("ids"))


def write_token_lists(df: DataFrame, path: str, keyword: str = KEYWORD,
                      in_order: bool = False) -> str:
    """Write ``encoded(file, doc_id, ids)``, one directory per input file, and return its root.

    The part files of a directory, taken by name, give the original line order. With
    ``in_order`` the partitions already follow (file, doc_id), as they do after a plain
    read, and nothing is shuffled; else the rows are dealt to partitions in order, so that a large file is spread over tasks.
    """
    target = f"{path.rstrip('/')}/{keyword}"
    keys = ("file", "doc_id")
    lines = (df if in_order else file_parts(df, keys)).sortWithinPartitions(*keys)
    lines.select("file", F.to_json("ids").alias("value")).write.partitionBy("file").text(target)
    return target


def write_token_matrix(df: DataFrame, path: str, keyword: str = KEYWORD, in_order: bool = False) -> str:
    """Write ``encoded(file, doc_id, ids)`` as one array of arrays for each file, and return the root.

    The part files of a directory ``file=<name>``, joined by name, are one JSON array, one list on each line. Only the first and the last
    key of each file are gathered beforehand, from a pass over the keys; a null list is written as an empty
    one, and a file without lists is not written. ``doc_id`` must be unique in its file. ``in_order`` as in ``write_token_lists``.
    """
    spark = df.sparkSession
    bounds_path = scratch_path(spark, "matrix-ends")
    df.groupBy("file").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")).write.parquet(bounds_path)
    ends = spark.read.parquet(bounds_path)
    if ends.count() > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} matrix files at a time")
    target = f"{path.rstrip('/')}/{keyword}"
    keys = ("file", "doc_id")
    bracketed = F.concat(
        F.when(F.col("doc_id") == F.col("_first"), "[").otherwise(","), F.coalesce(F.to_json("ids"), F.lit("[]")),
        F.when(F.col("doc_id") == F.col("_last"), "]").otherwise(""))
    lines = (df if in_order else file_parts(df, keys)).join(F.broadcast(ends), "file").sortWithinPartitions(*keys)
    lines.select("file", bracketed.alias("value")).write.partitionBy("file").text(target)
    return target


def write_split(df: DataFrame, path: str, name: str = "", order_by: Sequence[str] | None = None,
                in_order: bool = False) -> str:
    """Write dev and train examples from one pass over the data.

    The outputs are ``split=dev<name>`` and ``split=train<name>``. With ``order_by`` their
    part files, read in name order, give the rows in that order. With ``in_order`` the partitions already follow it, as
    ``file_parts`` and ``seeded_parts`` leave them; then each is sorted on its own and nothing is shuffled.
    """
    labelled = df.withColumn("split", F.concat("split", F.lit(name)))
    if order_by:
        columns = ["split", *order_by]
        labelled = labelled.sortWithinPartitions(*columns) if in_order else labelled.orderBy(*columns)
    labelled.select("split", F.to_json("ids").alias("value")).write.partitionBy("split").text(path)
    return path
