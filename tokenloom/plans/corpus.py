"""From text files to a tokenizer, to token lists, to dev and train examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEV_RATIO, EOS_ID, MIN_FREQUENCY, VOCAB_SIZE
from ..functions.text import strip_blank_lines
from ..operators.bpe import Tokenizer, bpe_train, word_counts, wordpiece_train
from ..operators.codec import encode
from ..operators.ordering import EXAMPLE_KEYS, file_parts, seeded_parts, shuffle_and_split, split_head
from ..operators.packing import pack
from ..sources.files import select_files
from ..sources.texts import read_jsonl_attr, read_tolerant
from ..sources.tokens import KEYWORD, read_token_lists, write_split, write_token_lists


def train_tokenizer(spark: SparkSession, paths: str | Sequence[str], kind: str = "BPE",
                    attr: str = "sents", size: int = VOCAB_SIZE,
                    min_frequency: int = MIN_FREQUENCY) -> tuple[Tokenizer, DataFrame]:
    """Train on sentence files; files that fail to parse are returned as rejects."""
    sents, rejects, _ = read_tolerant(spark, paths, attr)
    if kind == "BPE":
        tok = bpe_train(word_counts(sents, "sent"), size, min_frequency)
    else:
        tok = wordpiece_train(sents, "sent", size, min_frequency)
    return tok, rejects


def encode_texts(corpus: DataFrame, tok: Tokenizer) -> DataFrame:
    """``corpus(file, doc_id, text)`` -> ``encoded(file, doc_id, ids)``; no shuffle."""
    cleaned = corpus.withColumn("text", strip_blank_lines(F.col("text")))
    return encode(cleaned, tok).select("file", "doc_id", "ids")


def encode_folder(spark: SparkSession, paths: str | Sequence[str], tok: Tokenizer, out: str,
                  attr: str = "text", keyword: str = KEYWORD) -> str:
    """Encode every JSON-lines file that is not itself an output; returns the output root.

    One pass: nothing between the reader and the writer is shuffled.
    """
    corpus = select_files(read_jsonl_attr(spark, paths, attr), include=".jsonl", exclude=keyword)
    return write_token_lists(encode_texts(corpus, tok), out, keyword, in_order=True)


def make_examples(encoded: DataFrame, trim: int | None = None, block: int | None = None,
                  dev_ratio: float = DEV_RATIO, shuffle: bool = False, seed: int = 0,
                  eos: int = EOS_ID) -> DataFrame:
    """``examples(file, doc_id, ex_idx, ids, split)``; shuffled ones carry ``pos``."""
    examples = pack(encoded, trim, block, eos)
    if shuffle:
        return shuffle_and_split(examples, dev_ratio, seed)
    return split_head(examples, dev_ratio)


def make_dataset(spark: SparkSession, paths: str | Sequence[str], out: str,
                 trim: int | None = None, block: int | None = None,
                 dev_ratio: float = DEV_RATIO, shuffle: bool = False, seed: int = 0,
                 eos: int = EOS_ID, name: str = "") -> str:
    """Pack encoded files, split them and write dev and train lists below ``out``, in order.

    Examples are labelled where they are and shuffled once, to the partition that their place in the order names.
    """
    encoded = read_token_lists(spark, paths).select("file", "doc_id", "ids")
    labelled = split_head(pack(encoded, trim, block, eos), dev_ratio, shuffle, seed)
    if shuffle:
        laid, order = seeded_parts(labelled, EXAMPLE_KEYS, seed), ("shuffle_key", *EXAMPLE_KEYS)
    else:
        laid, order = file_parts(labelled, EXAMPLE_KEYS), EXAMPLE_KEYS
    return write_split(laid, out, name, order, in_order=True)
