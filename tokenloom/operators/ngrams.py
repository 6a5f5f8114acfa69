"""N-gram statistics of the encoded corpus: ranked, tempered and sampled continuations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bounds_from_ends, let
from ..functions.hashing import hash_int, seeded_hash
from .ordering import top_k


def _ngrams(df: DataFrame, names: Sequence[str], ids: str) -> DataFrame:
    """One row per n-gram, one column per place; n-grams stay inside a list."""
    def windows(v: Column) -> Column:
        grams = F.transform(v, lambda _, i: F.struct(
            *[F.get(v, i + k).alias(name) for k, name in enumerate(names)]))
        return F.slice(grams, 1, F.greatest(F.size(v) - len(names) + 1, F.lit(0)))

    return df.select(F.inline(let(F.col(ids), windows)))


def ngram_counts(df: DataFrame, names: Sequence[str], ids: str = "ids") -> DataFrame:
    """``(*names, n)``, summed on the map side before the shuffle."""
    return _ngrams(df, names, ids).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


def fill_slot_topk(df: DataFrame, k: int = 3, ids: str = "ids") -> DataFrame:
    """``(prev, next, mid, n, rank)``: the most frequent tokens between two neighbours.

    Ties go to the smaller id. A ranked group holds at most one row per vocabulary entry.
    """
    counts = ngram_counts(df, ("prev", "mid", "next"), ids)
    return top_k(counts, ["prev", "next"], [F.desc("n"), "mid"], k)


def _weighted(df: DataFrame, temp: float, ids: str) -> DataFrame:
    counts = ngram_counts(df, ("prev", "next"), ids)
    return counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(1.0 / temp)))


def next_token_distribution(df: DataFrame, temp: float = 0.75, ids: str = "ids") -> DataFrame:
    """``(prev, next, n, p)`` with p proportional to ``n ** (1 / temp)`` per context.

    The context totals are aggregated and joined, so a context that follows a third of
    all tokens is summed on the map side rather than sorted in one task.
    """
    weighted = _weighted(df, temp, ids)
    totals = weighted.groupBy("prev").agg(F.sum("weight").alias("total"))
    shares = weighted.join(totals, "prev")
    return shares.select("prev", "next", "n", (F.col("weight") / F.col("total")).alias("p"))


def sample_next(df: DataFrame, n: int = 3, temp: float = 0.75, seed: int = 0,
                ids: str = "ids") -> DataFrame:
    """``(prev, draw, next)``: ``n`` seeded draws per context from the tempered distribution.

    An exponential race: the smallest ``-ln(u) / weight`` wins with probability
    proportional to the weight. All draws are one aggregation.
    """
    def arrival(draw: int) -> Column:
        h = seeded_hash(seed, F.lit(draw), "prev", "next")
        u = (hash_int(h, 0) + 1) / F.lit(4294967296.0)
        return F.struct((-F.ln(u) / F.col("weight")).alias("at"), "next")

    races = _weighted(df, temp, ids).groupBy("prev").agg(
        *[F.min(arrival(d))["next"].alias(f"d{d}") for d in range(n)]
    )
    draws = F.posexplode(F.array(*[f"d{d}" for d in range(n)])).alias("draw", "next")
    return races.select("prev", draws)


def repeated_ngrams(df: DataFrame, n: int = 3, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``([file,] doc_id, gram, n)``: n-grams that a document holds more than once.

    Keys are unique within a file, so a column ``file`` stays. A document is one row, so its n-grams are sorted and counted in place: no shuffle.
    """
    def counted(sorted_: Column) -> Column:
        def last_of_run(i: Column) -> Column:
            after = F.get(sorted_, i)
            return after.isNull() | (after != F.get(sorted_, i - 1))

        ends = F.filter(F.transform(sorted_, lambda _, i: i + 1), last_of_run)
        runs = F.filter(bounds_from_ends(ends), lambda b: b["len"] > 1)
        return F.transform(runs, lambda b: F.struct(
            F.get(sorted_, b["start"]).alias("gram"), b["len"].alias("n")))

    def grams(v: Column) -> Column:
        slices = F.transform(v, lambda _, i: F.slice(v, i + 1, n))
        return F.sort_array(F.slice(slices, 1, F.greatest(F.size(v) - n + 1, F.lit(0))))

    found = let(let(F.col(ids), grams), counted)
    return df.select(*(c for c in ("file", key) if c in df.columns), F.inline(found))
