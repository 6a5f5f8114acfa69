"""From tagged sentences to label-aligned train and test sets, and from predictions to scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..constants import NER_LABELS, TEST_FRACTION, TUNING_MAX_LENGTH
from ..operators.bpe import Tokenizer
from ..operators.ordering import split_fraction
from ..operators.tagging import (
    align_labels,
    drop_ignored,
    drop_source_columns,
    sentence_predictions,
    span_scores,
)


def tagging_dataset(tagged: DataFrame, tok: Tokenizer, words: str = "token",
                    labels: str = "ner", label_ids: Mapping[str, int] = NER_LABELS,
                    test_size: float = TEST_FRACTION, seed: int = 0,
                    max_len: int = TUNING_MAX_LENGTH) -> DataFrame:
    """``(sent_id, split, input_ids, labels)`` from ``tagged(sent_id, token, ner)``."""
    sources = [c for c in tagged.columns if c != "sent_id"]
    parted = split_fraction(tagged, test_size, seed)
    aligned = align_labels(parted, tok, words, labels, label_ids, max_len)
    return drop_source_columns(aligned, sources)


def evaluate(predictions: DataFrame, label_ids: Mapping[str, int] = NER_LABELS) -> DataFrame:
    """One row of scores from ``predictions(sent_id, pos, logits, label)``."""
    return span_scores(drop_ignored(sentence_predictions(predictions), label_ids))
