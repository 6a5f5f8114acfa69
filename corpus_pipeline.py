"""Documents -> packed training sequences: toxicity, near-duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but
the last return the columns of ``docs``; the last returns the packed token pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import minhash, packing, suffixes, toxicity
from tokenloom.llm.common import settle
from tokenloom.llm.queries import WORD_TOKENIZER
from tokenloom.session import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold. Null and empty texts score 0 and stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.below(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return minhash.keep_one(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes and more that a document with a smaller id has too.

    A character cut in two loses its remaining bytes. ``n_chars``, where there is such a column, follows the text.
    Documents of which nothing is left go, unless they were empty before.
    """
    return suffixes.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of at most 2048 ids and their places in sequences, with the ids."""
    return packing.pack_documents(docs, WORD_TOKENIZER, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_duplicates),
    ("suffixes", drop_repeats),
    ("packing", pack_sequences),
]

#: SQL expresses none of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
