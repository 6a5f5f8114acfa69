"""Counters over a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def corpus_counts(df: DataFrame, sentences: Column, examples: Column,
                  file: str = "file") -> DataFrame:
    """``(file, docs, sentences, examples)`` per file, and a total row whose file is NULL.

    ``sentences`` and ``examples`` count within one document.
    """
    per_doc = df.select(file, sentences.alias("s"), examples.alias("e"))
    return per_doc.rollup(file).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("s").cast("bigint").alias("sentences"),
        F.sum("e").cast("bigint").alias("examples"),
    )
