"""Counts of unigram-model tokens without tokenising: Aho-Corasick matches and a count-only Viterbi.

An automaton over the vocabulary reports all pieces that end at a character. The search keeps for each
position only the best score and the number of pieces that gives it. Ties go to the
piece that begins first, as a search from left to right with a strict comparison
decides; where no piece covers a single character, that one is unknown, ten below the lowest score, and
adjoining unknown characters are one piece, or their bytes where the vocabulary falls back on bytes.
Texts are cut before spaces, which become word marks, so a word is searched once and remembered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, bounded_batches, renamed, tidy

MARK = "▁"
UNKNOWN_PENALTY = 10.0
WORDS = 1 << 19


class UnigramCounter:
    """Numbers of tokens by a unigram vocabulary of ``(piece, score)``."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.words = Memo(self.count_word, WORDS)

    def count_word(self, word: str) -> int:
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        single = bytearray(n)
        for end, (length, score) in self.automaton.iter(word):
            ends[end + 1].append((length, score))
            if length == 1:
                single[end] = 1
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        unknown = bytearray(n + 1)  # the best way to a position ends in an unknown character
        for at in range(1, n + 1):
            top, top_count, top_unknown = -math.inf, 0, 0
            for length, score in sorted(ends[at], reverse=True):  # those that begin first come first
                value = best[at - length] + score
                if value > top:
                    top, top_count, top_unknown = value, count[at - length] + 1, 0
            if not single[at - 1]:
                value = best[at - 1] + self.unknown
                if value > top:
                    top, top_unknown = value, 1
                    if self.byte_fallback:
                        top_count = count[at - 1] + len(word[at - 1].encode())
                    else:
                        top_count = count[at - 1] + (not unknown[at - 1])
            best[at], count[at], unknown[at] = top, top_count, top_unknown
        return count[n]

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        words = (marked if marked.startswith(MARK) else MARK + marked).split(MARK)[1:]
        return sum(map(self.words.__getitem__, map(MARK.__add__, words)))


def zipf_vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece model in rank order, the unknown first, with a Zipf score by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.IdToPiece(i), -math.log(i + 2)) for i in range(model.GetPieceSize())]


@lru_cache(maxsize=2)
def counter(path: str) -> UnigramCounter:
    """One per Python worker."""
    return UnigramCounter(zipf_vocabulary(path), True)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens)`` of every row; null and empty texts have none. Other columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(count, batch.column("text").to_pylist()), pa.int64())], names=["doc_id", "n_tokens"])

    bounded_batches(docs.sparkSession)
    texts = renamed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return texts.mapInArrow(tidy(run), "doc_id bigint, n_tokens bigint")
