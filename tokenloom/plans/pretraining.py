"""From split files to the padded, masked batches of one epoch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from ..constants import BATCH_SIZE, MASK_RATE, PAD_ID
from ..operators.batches import clm_labels, mlm_mask, ordered_batches, whole_word_mask
from ..operators.ordering import file_positions, shuffle_rows
from ..sources.tokens import read_token_lists

LINE_KEYS = ("file", "doc_id")


def training_batches(examples: DataFrame, vocab_size: int, keys: Sequence[str], objective: str = "whole_word",
                     starts: Callable[[Column], Column] | None = None, size: int = BATCH_SIZE, seed: int | None = 0,
                     p: float = MASK_RATE, pad: int = PAD_ID) -> DataFrame:
    """``batches(batch_id, row, input_ids, attention_mask, labels)`` of ``examples(*keys, ids)``.

    ``objective`` is ``"whole_word"`` (needs ``starts``, the test of a word's first token), ``"token"`` or ``"causal"``. The seed
    orders the rows and draws the masks, so each epoch takes its own; None keeps the order of (file, line), with
    masks of seed 0. Examples are masked where they are, and shuffled once to their batch.
    """
    place = partial(shuffle_rows, seed=seed) if seed is not None else _in_file_order
    if objective == "causal":
        return clm_labels(ordered_batches(examples, place, keys, size, pad), pad)
    if objective == "whole_word":
        if starts is None:
            raise ValueError("whole-word masking needs the test of a word's first token")
        masked = whole_word_mask(examples, vocab_size, keys, starts, p, seed or 0)
    elif objective == "token":
        masked = mlm_mask(examples, vocab_size, keys, p, seed or 0)
    else:
        raise ValueError("objective must be whole_word, token or causal")
    return ordered_batches(masked, place, keys, size, pad, ids="input_ids", labels="labels", lengths_of=(examples, "ids"))


def batches_of_files(spark: SparkSession, paths: str | Sequence[str], vocab_size: int, **options) -> DataFrame:
    """``training_batches`` of the token lists that ``write_split`` left, keyed by file and line."""
    lists = read_token_lists(spark, paths).select("file", "doc_id", "ids")
    return training_batches(lists, vocab_size, LINE_KEYS, **options)


def _in_file_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return file_positions(df, keys if len(keys) == 3 else (*keys, keys[-1]))
