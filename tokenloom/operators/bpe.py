"""Vocabulary training as rounds of small Spark jobs.

A word is kept as a string with one character per token id, so that the order of pairs by id
is the order of strings and a pair is found in a word by plain substring search.

Pairs are counted once. A merge only lowers the counts of pairs that exist already, and pairs
with its own new symbol are new, so a list of the best pairs is corrected by what the merged
words lost and gained, and stays exact for all pairs above the count at which it was cut off.
Only when the best pair falls to that count is everything counted again.

A round tries several merges in one pass over the words, in the order a small sample foretells, and reports what
each does to the counts. The driver takes them one by one, as long as each is the best pair by exact counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from heapq import heapify, heappop, heappush, nsmallest
from operator import add, or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MIN_FREQUENCY, SPECIAL_TOKENS, UNK_ID, VOCAB_SIZE, byte_alphabet
from ..functions.cutting import character_classes, cut_parts, readable
from ..functions.fragments import CODES, HEAD, NONE, Joints, PairCounter, laid_parts, strings
from ..functions.text import to_byte_symbols, utf8_as_latin1
from ..session import remove_path, scratch_path, written

SURROGATES = 0xD800, 0x800  # first code point and number of those no string may hold
ADJACENT = "(?s)(?=(..))"  # every overlapping pair of characters

TOP_PAIRS = 1000  # best pairs a round chooses from
LISTED_PAIRS = 50_000  # best pairs the driver holds after a count
SETTLE_MERGES = 64  # merges after which the words are written anew
CUT_MERGES = 6  # merges after which fragments are cut again, between symbols whose pairs have become too rare
FIRST_GUESS, MOST_GUESSED = 16, 64  # merges a round tries
MOST_SOUGHT = 24  # pairs for which words are searched before they are laid out
GUESS_WORDS, GUESS_SYMBOLS = 8_000, 128  # words from which merges are foretold, and what is taken of each
HELD_PIECES, SENT_PIECES = 1 << 20, 1 << 16  # pieces whose counts a worker adds up before it sends them, and sends at once
HELD_FRAGMENTS, HELD_BYTES = 1 << 18, 16 << 20  # whose counts a worker adds up
MAX_ALPHABET = 300_000  # more characters than Unicode has assigned
MAX_JOINTS = 1_000_000  # pairs of neighbours between which units are not cut
FORETOLD_MERGES, FORETOLD_SHARE, FINER_BY = 256, 0.8, 4  # how low pairs are kept at first, and then


BPE, WORDPIECE = "BPE", "WordPiece"


@dataclass(frozen=True)
class Tokenizer:
    """``vocab(id, token)`` and ``merges(rank, left, right, new_id)``, the kind of model, and its special tokens.

    A WordPiece model encodes by its tokens alone; those inside a word begin with ``prefix``.
    """

    vocab: DataFrame
    merges: DataFrame
    kind: str = BPE
    specials: tuple[str, ...] = SPECIAL_TOKENS
    unknown: str = SPECIAL_TOKENS[UNK_ID]
    prefix: str = "##"


def symbol(token_id: int) -> str:
    """The character that stands for a token id."""
    first, width = SURROGATES
    code = token_id + 1
    return chr(code if code < first else code + width)


def symbol_id(char: Column) -> Column:
    """The token id behind a symbol character."""
    first, width = SURROGATES
    code = F.ascii(char)
    return F.when(code < first, code - 1).otherwise(code - 1 - width)


def word_counts(texts: DataFrame, text: str = "text",
                add_prefix_space: bool = True) -> DataFrame:
    """``words(piece, n)``: distinct byte-level pieces of the corpus and their counts.

    Arrow workers cut the texts, ``PART_BYTES`` at a time, and add up the counts of a bounded number of pieces.
    """
    spark = texts.sparkSession
    classes = spark.sparkContext.broadcast(character_classes(spark))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for lists in (part for batch in batches for part in cut_parts(batch.column(0), classes.value, (), add_prefix_space)):
            found = lists.flatten().value_counts()
            held.append(pa.table([found.field("values"), found.field("counts")], ["piece", "n"]))
            if sum(map(len, held)) > HELD_PIECES:
                held = [_added_up(held)]
                if len(held[0]) > HELD_PIECES // 2:
                    yield from held.pop().to_batches(max_chunksize=SENT_PIECES)
        if held:
            yield from _added_up(held).to_batches(max_chunksize=SENT_PIECES)

    found = texts.select(readable(F.col(text))).mapInArrow(run, "piece string, n bigint")
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


def _added_up(counts: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(counts).group_by("piece", use_threads=False).aggregate([("n", "sum")])
    return found.select(["piece", "n_sum"]).rename_columns(["piece", "n"])


def base_tokens(specials: Sequence[str] = SPECIAL_TOKENS) -> list[str]:
    """Special tokens in the given order, then the byte symbols sorted."""
    return [*specials, *sorted(byte_alphabet())]


def initial_vocab(words: DataFrame, specials: Sequence[str] = SPECIAL_TOKENS) -> DataFrame:
    """``vocab(id, token, n)`` before any merge; ``n`` counts the symbol in the corpus."""
    spark = words.sparkSession
    rows = list(enumerate(base_tokens(specials)))
    vocab = spark.createDataFrame(rows, "id int, token string")
    used = (
        words.select("n", F.explode(F.split(to_byte_symbols(F.col("piece")), "")).alias("token"))
        .groupBy("token").agg(F.sum("n").alias("n"))
    )
    special = F.col("id") < len(specials)
    # At most one row per byte symbol on either side.
    joined = vocab.join(F.broadcast(used), "token", "left")
    return joined.select(
        "id", "token", F.when(special, 0).otherwise(F.coalesce("n", F.lit(0))).alias("n")
    )


def byte_words(words: DataFrame, specials: Sequence[str] = SPECIAL_TOKENS) -> DataFrame:
    """``words(word, n)`` with the pieces spelled in the symbols of their byte tokens."""
    ids = {token: i for i, token in enumerate(base_tokens(specials))}
    spelling = "".join(symbol(ids[char]) for char in byte_alphabet())
    latin1 = "".join(map(chr, range(256)))
    return words.select(
        F.translate(utf8_as_latin1(F.col("piece")), latin1, spelling).alias("word"), "n"
    )


def _pair_counts(words: DataFrame, min_frequency: int) -> DataFrame:
    pairs = F.explode(F.regexp_extract_all("word", F.lit(ADJACENT), F.lit(1)))
    return (
        words.select("n", pairs.alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= min_frequency)
    )


def pair_counts(words: DataFrame, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """``pairs(left, right, n)``: adjacent symbols weighted by word count."""
    return _pair_counts(words, min_frequency).select(
        symbol_id(F.substring("pair", 1, 1)).alias("left"),
        symbol_id(F.substring("pair", 2, 1)).alias("right"),
        "n",
    )


def merge_batch(ranked: list[tuple[str, int]], complete: bool, room: int,
                known: Callable[[str], bool], joined: Callable[[str], str]) -> list[str]:
    """The leading pairs that may be merged together with the result of one at a time.

    ``ranked`` holds (pair, count), best first. Two pairs touch if one ends in the symbol
    the other begins with; merging a pair changes the counts of the touching pairs only,
    and no pair it creates is more frequent than one of those. So pairs are taken until
    one touches, and of these the first, and whatever is more frequent than the best
    touching pair that was left out, is safe. ``complete`` tells that no pair is missing
    below ``ranked``.
    """
    taken: list[tuple[str, int]] = []
    firsts: set[str] = set()
    seconds: set[str] = set()
    made: set[str] = set()
    closed = False
    bound = 0 if complete else ranked[-1][1]
    for pair, count in ranked:
        left, right = pair
        if left in seconds or right in firsts:
            bound = count
            break
        if closed:
            continue
        taken.append((pair, count))
        firsts.add(left)
        seconds.add(right)
        token = joined(pair)
        repeated = known(token) or token in made
        made.add(token)
        room -= not repeated
        closed = left == right or repeated or room == 0
    return [pair for k, (pair, count) in enumerate(taken) if k == 0 or count > bound]


class PieceMerger:
    """Applies merges ``(rank, left, right, new_id)`` to many pieces at once, in each the lowest rank first.

    A step takes, in every piece that still holds a pair, all places of its best one.
    """

    NONE = np.iinfo(np.int64).max  # the rank of what is no pair

    def __init__(self, merges: np.ndarray):
        merges = merges[np.lexsort((merges[:, 3], merges[:, 0]))]
        self.new = merges[:, 3].astype(np.int32)
        self.keys, self.ranks = np.unique(merges[:, 1] << 32 | merges[:, 2], return_index=True)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], self.NONE)

    def __call__(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged ids, and their number in each piece; the pieces' ids lie end to end."""
        sizes = sizes.copy()
        if not len(self.keys) or len(ids) < 2:
            return ids, sizes
        piece = np.repeat(np.arange(len(sizes)), sizes)
        ranks = np.full(len(ids), self.NONE)  # of the pair that begins at each place
        ranks[:-1] = np.where(piece[1:] == piece[:-1], self._rank(ids[:-1], ids[1:]), self.NONE)
        done = []  # places of pieces in the result, and their ids
        while len(ids):
            heads = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            lens = np.diff(heads, append=len(ids))
            best = np.minimum.reduceat(ranks, heads)
            over = best == self.NONE
            if over.any():
                rest = np.repeat(~over, lens)
                done.append((piece[~rest], ids[~rest]))
                ids, piece, ranks = ids[rest], piece[rest], ranks[rest]
                best, lens = best[~over], lens[~over]
                if not len(ids):
                    break
            at = np.flatnonzero(ranks == np.repeat(best, lens))
            at = at[_alternate(at)]
            sizes -= np.bincount(piece[at], minlength=len(sizes))
            ids[at] = self.new[ranks[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, piece, ranks = ids[keep], piece[keep], ranks[keep]
            at -= np.arange(len(at))
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(ids) - 1)
                inside = (left < right) & (piece[left] == piece[right])
                ranks[left] = np.where(inside, self._rank(ids[left], ids[right]), self.NONE)
        pieces, found = (np.concatenate(parts) for parts in zip(*done))
        return found[np.argsort(pieces, kind="stable")], sizes


def _alternate(at: np.ndarray, follow: np.ndarray | None = None) -> np.ndarray:
    """Of ascending places, every other one of those that follow each other directly, or by the links ``follow``."""
    index = np.arange(len(at))
    starts = np.concatenate([[True], at[1:] != (at[:-1] + 1 if follow is None else follow[at[:-1]])])
    return (index - np.maximum.accumulate(np.where(starts, index, 0))) % 2 == 0


PAIR_BITS = 21  # a pair's key is left << 21 | right, by code points; keys are in the order of pairs
SLICE_SYMBOLS = 1 << 19  # laid end to end at a time, to stay in the cache


def pair_key(pair: str) -> int:
    return ord(pair[0]) << PAIR_BITS | ord(pair[1])


def key_pair(key: int) -> str:
    return chr(key >> PAIR_BITS) + chr(key & (1 << PAIR_BITS) - 1)


def lay(words: pa.Array, n: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words end to end, with a 0 before, between and after them, and each one's weight."""
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words.cast(pa.string())), "\0")[0].as_py()
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False) + 1
    weights = n.to_numpy(zero_copy_only=False)
    return (np.frombuffer(f"\0{joined}\0".encode("utf-32-le"), "<i4"),
            np.concatenate([np.zeros(1, weights.dtype), np.repeat(weights, sizes)]))


def _whole(codes: np.ndarray, begins: np.ndarray, *beside: np.ndarray) -> tuple:
    """The fragments of two symbols and more, and what lies beside their first one."""
    starts = np.flatnonzero(begins)
    sizes = np.diff(starts, append=len(codes))
    kept, starts = codes[np.repeat(sizes > 1, sizes)], starts[sizes > 1]
    sizes = sizes[sizes > 1]
    return strings(kept, np.cumsum(sizes) - sizes), *(x[starts] for x in beside)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(pc.utf8_length(batch.column("word")).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_SYMBOLS, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first)


def _pairs_at(codes: np.ndarray, weights: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left, right = codes[at].astype(np.int64), codes[at + 1].astype(np.int64)
    inside = (left > 0) & (right > 0)
    return (left << PAIR_BITS | right)[inside], weights[at][inside]


def merge_laid(codes: np.ndarray, weights: np.ndarray, pair: str, made: str) -> tuple[np.ndarray, ...]:
    """Merge one pair in laid words: the codes and weights afterwards, and what the count of each pair gained or lost."""
    left, right = map(ord, pair)
    at = np.flatnonzero((codes[:-1] == left) & (codes[1:] == right))
    if left == right and len(at):  # every other place of a run
        at = at[_alternate(at)]
    if not len(at):
        return codes, weights, np.empty(0, np.int64), np.empty(0, weights.dtype)
    apart = np.concatenate([[True], at[1:] != at[:-1] + 2])
    lost, less = _pairs_at(codes, weights, np.concatenate([at, at + 1, at[apart] - 1]))
    keep = np.ones(len(codes), bool)
    keep[at + 1] = False
    codes, weights = codes[keep], weights[keep]
    at = at - np.arange(len(at))
    codes[at] = ord(made)
    apart = np.concatenate([[True], at[1:] != at[:-1] + 1])
    gained, more = _pairs_at(codes, weights, np.concatenate([at, at[apart] - 1]))
    return codes, weights, *summed(np.concatenate([lost, gained]), np.concatenate([-less, more]))


def merge_steps(codes: np.ndarray, weights: np.ndarray, steps: Sequence[tuple[str, str]], silent: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Merge pairs one after the other in laid words, as ``merge_laid`` does; also what each step gained or lost, but for
    the first ``silent`` ones.

    The places of all pairs are looked up once. Symbols are linked to their neighbours instead of being moved, and the pairs that a
    step makes are handed to the later steps, so that a step costs what it merges and not a pass over the words.
    """
    if len({pair for pair, _ in steps}) < len(steps):  # a pair that comes again has two turns
        found = []
        for k, (pair, made) in enumerate(steps):
            codes, weights, *change = merge_laid(codes, weights, pair, made)
            found += [change] if k >= silent else []
        return codes, weights, found
    codes = codes.copy()
    turns = _Turns([pair for pair, _ in steps], int(codes.max()), [made for _, made in steps])
    follow, before = np.arange(1, len(codes) + 1), np.arange(-1, len(codes) - 1)
    turn = turns.of(codes[:-1], codes[1:])
    places = np.flatnonzero(turn >= 0)
    places = places[np.argsort(turn[places], kind="stable")]
    ends = np.searchsorted(turn[places], np.arange(len(steps) + 1))
    waiting: list[list[np.ndarray]] = [[places[a:b]] for a, b in zip(ends[:-1], ends[1:])]

    def pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = codes[at].astype(np.int64), codes[follow[at]].astype(np.int64)
        inside = (left > 0) & (right > 0)
        return (left << PAIR_BITS | right)[inside], weights[at][inside]

    found = []
    for k, (pair, made) in enumerate(steps):
        at = waiting[k][0] if len(waiting[k]) == 1 else np.unique(np.concatenate(waiting[k]))
        left, right = map(ord, pair)
        at = at[codes[at] == left]
        at = at[codes[follow[at]] == right]
        if left == right and len(at):
            at = at[_alternate(at, follow)]
        change = np.empty(0, np.int64), np.empty(0, weights.dtype)
        if len(at):
            gone = follow[at]
            apart = np.concatenate([[True], at[1:] != follow[gone[:-1]]])
            if k >= silent:
                lost, less = pairs(np.concatenate([at, gone, before[at[apart]]]))
            after = follow[gone]
            codes[at], codes[gone] = ord(made), -1
            follow[at], before[after] = after, at
            new = np.concatenate([at, before[at[apart]]])
            if k >= silent:
                gained, more = pairs(new)
                change = summed(np.concatenate([lost, gained]), np.concatenate([-less, more]))
            turn = turns.of(codes[new], codes[follow[new]])
            new, turn = new[turn > k], turn[turn > k]
            for later in np.unique(turn):
                waiting[later].append(new[turn == later])
        if k >= silent:
            found.append(change)
    keep = codes >= 0
    return codes[keep], weights[keep], found


class _Turns:
    """Which of some different pairs two neighbours are, or -1."""

    def __init__(self, pairs: Sequence[str], most: int, others: Sequence[str]):
        most = max([most, *map(ord, "".join(pairs)), *map(ord, others)])
        sides = [sorted({pair[side] for pair in pairs}) for side in (0, 1)]
        self.left, self.right = (np.zeros(most + 1, np.int32) for _ in sides)
        for table, side in zip((self.left, self.right), sides):
            table[[ord(char) for char in side]] = np.arange(1, len(side) + 1)
        self.width = len(sides[1]) + 1
        self.turn = np.full((len(sides[0]) + 1) * self.width, -1, np.int16)
        for k, pair in enumerate(pairs):
            self.turn[self.left[ord(pair[0])] * self.width + self.right[ord(pair[1])]] = k

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.turn[self.left[left] * self.width + self.right[right]]


class Words:
    """The words as a table in the shared folder, with a copy in memory, and the merges since it was written.

    Writing it cuts the lineage, and lost executors only cost a new read. Words of one
    symbol hold no pair any more and are left out. A word of the table can hold a pair, after the
    merges, only if it holds the two symbols as they were spelled in the table; that substring
    is the index by which the words of a merge are found.
    """

    def __init__(self, words: DataFrame):
        self.spark = words.sparkSession
        self.path = scratch_path(self.spark, "words")
        words.filter(F.length("word") > 1).write.parquet(self.path)
        self.table = self.spark.read.parquet(self.path).persist(StorageLevel.MEMORY_AND_DISK)
        self.merges: list[tuple[str, str]] = []
        self.spelling: dict[str, str] = {}

    def drop(self) -> None:
        self.table.unpersist()
        remove_path(self.spark, self.path)

    def _spelled(self, symbols: str) -> str:
        return "".join(self.spelling.get(s, s) for s in symbols)

    def merge_only(self, batch: Sequence[tuple[str, str]]) -> None:
        for pair, made in batch:
            self.merges.append((pair, made))
            self.spelling[made] = self._spelled(pair)

    def changes(self, batch: Sequence[tuple[str, str]]) -> list[dict[int, int]]:
        """What the count of each pair gains or loses by each ``(pair, symbol)``, merged one after the other.

        Only words that hold one of the pairs are looked at, where they are few. Pairs next to a merged one change, so there are
        at most a few times as many as tokens for each merge.
        """
        known = dict(self.spelling)
        spelled = []
        for pair, made in batch:
            spelled.append("".join(known.get(s, s) for s in pair))
            known[made] = spelled[-1]
        sought = list(dict.fromkeys(spelled))
        rows = self.table
        if len(sought) <= MOST_SOUGHT:
            rows = rows.filter(reduce(or_, (F.contains("word", F.lit(s)) for s in sought)))
        before, steps = list(self.merges), list(batch)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in steps]
            for part in _slices(batches):
                codes, weights = lay(part.column("word"), part.column("n"))
                for k, found in enumerate(merge_steps(codes, weights, [*before, *steps], len(before))[2]):
                    if len(found[0]):
                        sums[k] = summed(*map(np.concatenate, zip(sums[k], found)))
            for k, (keys, values) in enumerate(sums):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), k, np.int32)), pa.array(keys), pa.array(values)], ["step", "pair", "n"])

        lost = rows.mapInArrow(run, "step int, pair bigint, n bigint") \
            .groupBy("step", "pair").agg(F.sum("n").alias("n")).filter("n <> 0")
        found: list[dict[int, int]] = [{} for _ in batch]
        for row in lost.collect():
            found[row.step][row.pair] = row.n
        return found

    def merge(self, batch: Sequence[tuple[str, str]]) -> dict[str, int]:
        """Merge ``(pair, symbol)`` and return what the count of each pair gained or lost by all of them."""
        total: Counter = Counter()
        for found in self.changes(batch):
            total.update(found)
        self.merge_only(batch)
        return {key_pair(key): n for key, n in total.items() if n}

    def merged(self, joined: Iterable[int] | None = None) -> DataFrame:
        """The words after the merges; with ``joined``, keys of pairs, cut between symbols that are no such pair."""
        merges = list(self.merges)
        keys = None if joined is None else np.fromiter(joined, np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _slices(batches):
                codes, weights = lay(part.column("word"), part.column("n"))
                for start in range(0, len(merges), SETTLE_MERGES):
                    some = merges[start:start + SETTLE_MERGES]
                    codes, weights, _ = merge_steps(codes, weights, some, len(some))
                if keys is None:
                    words = codes.tobytes().decode("utf-32-le").split("\0")[1:-1]
                    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), part.column("n")], ["word", "n"])
                else:
                    begins = np.concatenate([[True], ~Joints(keys >> PAIR_BITS, keys & (1 << PAIR_BITS) - 1)(codes[:-1], codes[1:])])
                    words, n = _whole(codes, begins, weights)
                    yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])

        words = self.table.select("word", "n").mapInArrow(run, "word string, n bigint")
        return words if keys is None else words.groupBy("word").agg(F.sum("n").alias("n"))

    def pairs(self) -> DataFrame:
        """``(pair, n)``: the count of each pair of the table by its key."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _slices(batches):
                codes, weights = lay(part.column("word"), part.column("n"))
                keys, values = summed(*_pairs_at(codes, weights, np.arange(len(codes) - 1)))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)], ["pair", "n"])

        return self.table.select("word", "n").mapInArrow(run, "pair bigint, n bigint") \
            .groupBy("pair").agg(F.sum("n").alias("n"))


class PairList:
    """Exact counts of all pairs above ``floor``, by key."""

    def __init__(self, state: Words, min_frequency: int):
        best = state.pairs().filter(F.col("n") >= min_frequency).orderBy(F.desc("n"), "pair").limit(LISTED_PAIRS)
        self.counts: dict[int, int] = {row.pair: row.n for row in best.collect()}
        full = len(self.counts) == LISTED_PAIRS
        self.floor = min(self.counts.values()) if full else min_frequency - 1
        self.queue = [(-n, key) for key, n in self.counts.items()]
        heapify(self.queue)

    def correct(self, changes: dict[int, int], made: str) -> None:
        """Pairs of the ``made`` symbol are new; others, unless listed, were and stay at or below the floor."""
        code, mask = ord(made), (1 << PAIR_BITS) - 1
        for key, change in changes.items():
            if key in self.counts or key >> PAIR_BITS == code or key & mask == code:
                n = self.counts.pop(key, 0) + change
                if n > self.floor:
                    self.counts[key] = n
                    heappush(self.queue, (-n, key))

    def first(self) -> int | None:
        """The best pair above the floor."""
        while self.queue:
            n, key = self.queue[0]
            if self.counts.get(key) == -n:
                return key if -n > self.floor else None
            heappop(self.queue)
        return None


class Guesser:
    """Foretells the next merges from a few words.

    Its words are drawn with chances by their counts, and what a merge does to them is scaled by its
    exact count. A guess decides only how many merges a round tries; each is checked against exact counts.
    """

    def __init__(self, table: DataFrame):
        u = (F.pmod(F.xxhash64("word"), F.lit(1 << 32)) + F.lit(0.5)) / F.lit(float(1 << 32))
        rows = table.select(F.substring("word", 1, GUESS_SYMBOLS).alias("word"), "n", (-F.ln(u) / F.col("n")).alias("at")) \
            .orderBy("at", "word").limit(GUESS_WORDS).collect()
        least = 1 / rows[-1].at if len(rows) == GUESS_WORDS else 0.0
        self.laid = lay(pa.array([r.word for r in rows], pa.string()), pa.array([max(r.n, least) for r in rows], pa.float64()))

    def ahead(self, listed: PairList, limit: int, following: Callable[[str], str | None]) -> list[tuple[str, str]]:
        """Up to ``limit`` merges in their likely order; ``following`` names a pair's new symbol, or ends the guess."""
        counts = dict(nsmallest(TOP_PAIRS, listed.counts.items(), key=lambda item: (-item[1], item[0])))
        found, (codes, weights) = [], self.laid
        while len(found) < limit and counts:
            key = min(counts, key=lambda k: (-counts[k], k))
            pair = key_pair(key)
            made = following(pair)
            if made is None:
                break
            found.append((pair, made))
            codes, weights, keys, changes = merge_laid(codes, weights, pair, made)
            changes = dict(zip(keys.tolist(), changes.tolist()))
            scale = counts[key] / -changes[key] if changes.get(key, 0) < 0 else 0.0
            for k, change in changes.items():
                if k in counts or made in key_pair(k):
                    counts[k] = counts.get(k, 0) + change * scale
            counts.pop(key)
        return found

    def keep(self, batch: Sequence[tuple[str, str]]) -> None:
        for pair, made in batch:
            self.laid = merge_laid(*self.laid, pair, made)[:2]


def learn_merges(words: DataFrame, tokens: list[str], size: int = VOCAB_SIZE,
                 min_frequency: int = MIN_FREQUENCY, continuing: str = "",
                 report: dict | None = None, cuts: _Cuts | None = None) -> Tokenizer:
    """Merge the most frequent pair until ``size`` tokens exist or no pair is frequent enough.

    Ties go to the smaller id pair. Only the best pairs and the changes of a round reach the
    driver; the words stay distributed. ``continuing`` is the prefix that marks non-initial
    symbols and is dropped inside a joined token. ``report`` gets the numbers of ``rounds``
    and full ``counts``. Words that ``cuts`` made hold all pairs down to a count only; below it they are cut anew.
    """
    spark = words.sparkSession
    tokens = list(tokens)
    ids = {token: i for i, token in enumerate(tokens)}
    by_symbol = {symbol(i): i for i in range(len(tokens))}
    merges: list[tuple[int, int, int, int]] = []
    done = {"rounds": 0, "counts": 0} if report is None else report
    done.update(rounds=0, counts=0)

    def joined(pair: str) -> str:
        left, right = (tokens[by_symbol[s]] for s in pair)
        return left + right.removeprefix(continuing)

    def follower() -> Callable[[str], str | None]:
        """Names new symbols one after the other, until there is no room or a token is there already."""
        made: dict[str, str] = {}

        def following(pair: str) -> str | None:
            names = ["".join(made.get(s) or tokens[by_symbol[s]] for s in c) for c in pair]
            token = names[0] + names[1].removeprefix(continuing)
            if token in ids or token in made.values() or len(tokens) + len(made) == size:
                return None
            new = symbol(len(tokens) + len(made))
            made[new] = token
            return new

        return following

    def record(pair: str) -> str:
        token = joined(pair)
        if token not in ids:
            ids[token] = len(tokens)
            by_symbol[symbol(len(tokens))] = len(tokens)
            tokens.append(token)
        merges.append((len(merges), *(by_symbol[s] for s in pair), ids[token]))
        return symbol(ids[token])

    def so_far() -> list[tuple[str, str]]:
        return [(symbol(left) + symbol(right), symbol(new)) for _, left, right, new in merges]

    def spread(words: DataFrame) -> DataFrame:
        return words.repartition(spark.sparkContext.defaultParallelism, "word")

    state = Words(spread(words))
    listed: PairList | None = None
    guesser: Guesser | None = None
    limit = FIRST_GUESS
    try:
        while len(tokens) < size:
            first = listed.first() if listed else None
            guess: list[tuple[str, str]] = []
            if first is None:
                least = cuts.least if cuts else min_frequency
                if listed and listed.floor < least:
                    if least <= min_frequency:
                        break
                    state.drop()
                    state, guesser = Words(spread(cuts.finer())), None
                    state.merge_only(so_far())
                    least = cuts.least
                if state.merges:
                    state = _rewritten(state)
                listed = PairList(state, least)
                done["counts"] += 1
                if (first := listed.first()) is None:
                    if listed.floor < least:
                        continue
                    # More pairs than are listed share the floor as their count: take the first of them.
                    first = min(listed.counts, key=lambda key: (-listed.counts[key], key))
                    guess = [(key_pair(first), symbol(len(tokens)))]
            done["rounds"] += 1
            if joined(key_pair(first)) in ids:  # pairs of a token that was there before may grow: count anew
                state.merge_only([(key_pair(first), record(key_pair(first)))])
                if cuts:  # what was cut between symbols may meet again in the token
                    state.drop()
                    state = Words(spread(cuts.words(cuts.least)))
                    state.merge_only(so_far())
                state, listed = _rewritten(state), None
                if guesser:
                    guesser.keep([(key_pair(first), symbol(merges[-1][3]))])
                continue
            guesser = guesser or Guesser(state.table)
            guess = guess or guesser.ahead(listed, limit, follower())
            taken = 0
            for (pair, made), found in zip(guess, state.changes(guess), strict=True):
                if taken and listed.first() != pair_key(pair):
                    break
                record(pair)
                listed.correct(found, made)
                taken += 1
            state.merge_only(guess[:taken])
            guesser.keep(guess[:taken])
            limit = min(MOST_GUESSED, max(FIRST_GUESS, 2 * taken))
            if cuts and listed.floor < cuts.least and len(state.merges) >= CUT_MERGES:
                state = _rewritten(state, listed.counts)
            elif len(state.merges) >= SETTLE_MERGES:
                state = _rewritten(state)
    finally:
        state.drop()
    return _tokenizer(spark, tokens, merges)


def _rewritten(state: Words, joined: Iterable[int] | None = None) -> Words:
    fresh = Words(state.merged(joined))
    state.drop()
    return fresh


def _tokenizer(spark: SparkSession, tokens: list[str], merges: list[tuple]) -> Tokenizer:
    return Tokenizer(
        spark.createDataFrame(list(enumerate(tokens)), "id int, token string"),
        spark.createDataFrame(merges, "rank int, left int, right int, new_id int"),
    )


def bpe_train(words: DataFrame, size: int = VOCAB_SIZE, min_frequency: int = MIN_FREQUENCY,
              specials: Sequence[str] = SPECIAL_TOKENS) -> Tokenizer:
    """Byte-level BPE from a histogram ``words(piece, n)``."""
    tok = learn_merges(byte_words(words, specials), base_tokens(specials), size, min_frequency)
    return replace(tok, specials=tuple(specials))


def byte_tokenizer(spark: SparkSession, specials: Sequence[str] = SPECIAL_TOKENS) -> Tokenizer:
    """The vocabulary before any merge: one token per byte."""
    return replace(_tokenizer(spark, base_tokens(specials), []), specials=tuple(specials))


def _neighbours(lines: DataFrame) -> DataFrame:
    """``(left, right, n)``: neighbouring codes of the texts, as ``PairCounter`` counts them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PairCounter()
        for codes in laid_parts(batches):
            counter.add(codes)
            if len(counter.keys) > HELD_PIECES:
                yield counter.found()
                counter = PairCounter()
        yield counter.found()

    return lines.mapInArrow(run, "left int, right int, n bigint").groupBy("left", "right").agg(F.sum("n").alias("n"))


class _Cuts:
    """The units cut into fragments between characters that no merge joins.

    A pair of symbols can't be more frequent than the characters that meet in it, the last one of its left and the first one of its right symbol.
    So all pairs with a count of at least ``least`` lie in fragments, where units are cut between neighbours with a lower
    count, and have their exact counts there. Fragments repeat much more than units do. After some merges they are cut again
    between symbols, by the same rule; it holds for symbols until a pair spells a token that was there before, and then the units are cut anew.
    When the best pair falls below ``least``, the units are cut again, at fewer places.
    """

    def __init__(self, lines: DataFrame, pairs: DataFrame, symbols: dict[int, str], min_frequency: int):
        self.lines, self.pairs, self.symbols, self.min_frequency = lines, pairs, symbols, min_frequency
        self.least = min_frequency

    def foretold(self, merges: int, known: int) -> int:
        """About the count of the last of so many merges, from a few lines; a wrong guess costs another cut or longer fragments."""
        rows = self.lines.select(F.substring("text", 1, GUESS_SYMBOLS).alias("text")).orderBy(F.rand(0)).limit(GUESS_WORDS).collect()
        words = ["".join([self.symbols[ord(r.text[0]) + HEAD], *(self.symbols[ord(c)] for c in r.text[1:])]) for r in rows]
        codes, weights = lay(pa.array(words, pa.string()), pa.array(np.ones(len(words)), pa.float64()))
        keys, counts = summed(*_pairs_at(codes, weights, np.arange(len(codes) - 1)))
        whole = self.pairs.filter(F.col("left") != NONE).agg(F.sum("n")).first()[0] or 0
        scale, counts, n = whole / max(1.0, counts.sum()), dict(zip(keys.tolist(), counts.tolist())), 0.0
        for k in range(min(merges, FORETOLD_MERGES)):
            if not counts:
                return self.min_frequency
            key = min(counts, key=lambda k: (-counts[k], k))
            n = counts[key]
            codes, weights, keys, changes = merge_laid(codes, weights, key_pair(key), symbol(known + k))
            for pair, change in zip(keys.tolist(), changes.tolist()):
                counts[pair] = counts.get(pair, 0) + change
            counts.pop(key)
        return int(FORETOLD_SHARE * n * scale)

    def words(self, least: int) -> DataFrame:
        """``words(word, n)``: the fragments of two symbols and more, and their counts, for ``least`` or a lower bound."""
        self.least = max(self.min_frequency, least)
        found = self.pairs.filter((F.col("left") != NONE) & (F.col("n") >= self.least)).limit(MAX_JOINTS + 1).toArrow()
        joined = [found[side].to_numpy() for side in ("left", "right")]
        if len(found) > MAX_JOINTS:  # too many to send to the workers: nothing is cut
            self.least, joined = self.min_frequency, None
        return _fragments(self.lines, self.symbols, joined)

    def finer(self) -> DataFrame:
        return self.words(self.least // FINER_BY)


def _fragments(lines: DataFrame, symbols: dict[int, str], joined: list[np.ndarray] | None) -> DataFrame:
    """``words(word, n)``: distinct runs of joined neighbours, spelled in symbols, and their counts."""
    codes = np.fromiter(symbols, np.int64, len(symbols))
    shared = lines.sparkSession.sparkContext.broadcast((codes, np.array([ord(s) for s in symbols.values()], np.int32), joined))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, spelled, joined = shared.value
        table = np.zeros(CODES, np.int32)
        table[codes] = spelled
        joints = None if joined is None else Joints(*joined)
        held: list[pa.Table] = []
        for part in laid_parts(batches):
            begins = part >= HEAD
            if joints is not None:
                begins[1:] |= ~joints(part[:-1], part[1:])
            found = _whole(table[part], begins)[0].value_counts()
            held.append(pa.table([found.field("values"), found.field("counts")], ["piece", "n"]))
            if sum(map(len, held)) > HELD_FRAGMENTS or sum(t.nbytes for t in held) > HELD_BYTES:
                held = [_added_up(held)]
                if len(held[0]) > HELD_FRAGMENTS // 2 or held[0].nbytes > HELD_BYTES // 2:
                    yield from held.pop().to_batches(max_chunksize=SENT_PIECES)
        if held:
            yield from _added_up(held).to_batches(max_chunksize=SENT_PIECES)

    found = lines.mapInArrow(run, "piece string, n bigint")
    return found.groupBy(F.col("piece").alias("word")).agg(F.sum("n").alias("n"))


def wordpiece_train(texts: DataFrame, text: str = "text", size: int = VOCAB_SIZE,
                    min_frequency: int = MIN_FREQUENCY,
                    specials: Sequence[str] = SPECIAL_TOKENS, prefix: str = "##") -> Tokenizer:
    """WordPiece vocabulary; each text is one unit, so merges may cross spaces.

    The alphabet is the byte symbols and every character of the corpus; the characters
    found after the first position get a second, prefixed symbol. Neighbouring characters are counted once, and the units
    are cut where two stand that are too rare to be merged, see ``_Cuts``.
    """
    lines = texts.select(readable(F.col(text)).alias("text")).filter(F.length("text") > 0)
    pairs = written(_neighbours(lines), "neighbours")
    sides = F.inline(F.array(
        F.struct(F.when(F.col("left") < HEAD, F.col("left")).alias("code"), F.lit(1).alias("inner")),
        F.struct(F.col("right").alias("code"), (F.col("left") != NONE).cast("int").alias("inner"))))
    seen = pairs.select(sides).filter("code >= 0").groupBy("code").agg(F.max("inner").alias("inner")).limit(MAX_ALPHABET + 1).collect()
    if len(seen) > MAX_ALPHABET:
        raise ValueError("the corpus has more distinct characters than Unicode assigns")
    alphabet = sorted({*byte_alphabet(), *(chr(row.code) for row in seen)})
    inner = sorted(chr(row.code) for row in seen if row.inner)
    tokens = [*specials, *alphabet, *(prefix + char for char in inner)]
    ids = {token: i for i, token in enumerate(tokens)}
    symbols = {**{ord(c) + HEAD: symbol(ids[c]) for c in alphabet}, **{ord(c): symbol(ids[prefix + c]) for c in inner}}
    cuts = _Cuts(lines, pairs, symbols, min_frequency)
    tok = learn_merges(cuts.words(cuts.foretold(size - len(tokens), len(tokens))), tokens, size, min_frequency,
                       continuing=prefix, cuts=cuts)
    return replace(tok, kind=WORDPIECE, specials=tuple(specials), prefix=prefix)
