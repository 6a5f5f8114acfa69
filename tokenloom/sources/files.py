"""Choosing input files by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path


class NoInputFiles(ValueError):
    """A listed input has no file that Spark would read."""


PART_NAME = r"^part-(\d+)-"  # how Spark calls the files of a folder that it writes


def file_label(df: DataFrame, join_parts: bool = True) -> Column:
    """The file a row came from: the ``file`` partition value where the layout has one, else the plain file name.

    With ``join_parts`` the parts of a folder that Spark wrote are one file, called like the folder.
    """
    if "file" in df.columns:
        return F.col("file")
    name = F.col("_metadata.file_name")
    if not join_parts:
        return name
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return F.when(name.rlike(PART_NAME), F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))).otherwise(name)


MAX_SPLITS = 2_000_000  # proven bound on the table of line counts that is broadcast


def numbered_lines(lines: DataFrame, counted: Column | None = None, per_file: bool = True) -> DataFrame:
    """Add ``file``, ``line`` and ``first`` to lines straight from ``spark.read.text``.

    ``line`` counts 0, 1, 2, ... in each file, or over all files without ``per_file``, however the files
    are split and dealt over tasks. ``first`` tells the first line of a physical file. Files follow
    each other by folder and name, and those that Spark wrote in several parts by part number. With ``counted`` only lines
    for which it holds count, and all lines without it must come at the end of a file.

    The lines are read once to count them by split, as a narrow table that is written to the shared folder. A line's
    number is the sum before its split plus its place in it, which is its place in the task less
    that of the split's first line. The lines stay where they are. If a later read cuts the
    files differently, the job fails.
    """
    spark = lines.sparkSession
    held = F.lit(1) if counted is None else counted.cast("int")
    placed = lines.select(
        *[c for c in lines.columns if c != "file"], file_label(lines).alias("file"),
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"))
    splits = placed.withColumn("_held", held).groupBy("file", "_path", "_start").agg(
        F.min("_row").alias("_first_row"), F.sum("_held").alias("_lines"))
    name = F.element_at(F.split("_path", "/"), -1)
    part = F.regexp_extract(name, PART_NAME, 1).try_cast("bigint")
    order = [F.expr("left(_path, length(_path) - length(substring_index(_path, '/', -1)))"),
             F.coalesce(part, F.lit(0)), "_path", "_start"]
    window = W.partitionBy("file").orderBy(*order) if per_file else W.orderBy("file", *order)
    before = F.sum("_lines").over(window.rowsBetween(W.unboundedPreceding, -1))
    path = scratch_path(spark, "line-counts")
    splits.withColumn("_before", F.coalesce(before, F.lit(0))).drop("file", "_lines").write.parquet(path)
    starts = spark.read.parquet(path)
    if starts.count() > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits; raise spark.sql.files.maxPartitionBytes")
    joined = placed.join(F.broadcast(starts), ["_path", "_start"], "left")
    gone = F.raise_error(F.lit("the files were split differently when their lines were counted")).cast("bigint")
    line = F.coalesce("_before", gone) + F.col("_row") - F.col("_first_row")
    return joined.withColumn("line", line).withColumn(
        "first", (F.col("_start") == 0) & (F.col("_row") == F.col("_first_row"))
    ).drop("_path", "_start", "_row", "_first_row", "_before")


def require_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The paths as a list, after checking that each one holds a readable file.

    Spark passes over names that begin with ``_`` or ``.`` without a word, even when such
    a path is given outright; here that is an error.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    if not listed:
        raise NoInputFiles("no input path given")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for item in listed:
        path = jvm.org.apache.hadoop.fs.Path(item)
        found = path.getFileSystem(conf).globStatus(path)
        names = [status.getPath().getName() for status in found or []]
        if not names or all(n.startswith(("_", ".")) and "=" not in n for n in names):
            raise NoInputFiles(f"Spark would read nothing from {item!r}; rename hidden files")
    return listed


def select_files(df: DataFrame, include: str | None = None, exclude: str | None = None,
                 suffix: str | None = None) -> DataFrame:
    """Rows of a listing whose ``file`` contains ``include``, lacks ``exclude`` and ends
    in ``suffix``.

    Works on any frame with a ``file`` column. On a path partitioned by ``file`` Spark
    turns the test into partition pruning, so the other files are not opened.
    """
    name = F.col("file")
    for wanted, test in (
        (include, lambda v: name.contains(v)),
        (exclude, lambda v: ~name.contains(v)),
        (suffix, lambda v: name.endswith(v)),
    ):
        if wanted:
            df = df.filter(test(wanted))
    return df


def list_files(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """The readable files under ``path`` as ``listing(path, file, size)``; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("size"),
    )
