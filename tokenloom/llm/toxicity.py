"""Toxicity by multiple-instance learning: sentences are scored, documents carry the labels.

A sentence has a logistic score over its selected words; a document is toxic when any sentence is,
so sentence scores combine by noisy-or, ``1 - prod(1 - p)``. Weights are fitted through that
combination from document labels alone, and the sentence scores then locate the offending sentences.

The fit uses at most about ``SAMPLE_ROWS`` labelled rows, half of them toxic at most, chosen by a
hash of the id, and at most ``VOCABULARY`` words; both are parameters. Scoring reads whole texts.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, per_batch, renamed, settle

SAMPLE_ROWS = 40_000
VOCABULARY = 2048
LEAST_GAIN = 10.0
THRESHOLD = 0.7
STEPS = 600
L2 = 2e-6
RATE = 0.1

_ENDS = b".!?\n\r"
_TABLE = bytes(
    10 if c in _ENDS else c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclasses.dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    bias: float


def sentences(text: bytes | None) -> list[bytes]:
    """Sentences with a word in them, ASCII letters lowered, other ASCII signs as spaces."""
    return [s for s in (text or b"").translate(_TABLE).split(b"\n") if s.strip()]


def sentence_scores(text: bytes | None, model: Model) -> np.ndarray:
    known, weight = model.weights.keys(), model.weights.__getitem__
    z = [model.bias + sum(map(weight, known & set(s.split()))) for s in sentences(text)]
    return 1 / (1 + np.exp(-np.clip(np.array(z, np.float64), -30, 30)))


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def sample_labelled(docs: DataFrame, labels: DataFrame, allowed: Column, rows: int = SAMPLE_ROWS,
                    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(id, text, y, weight)`` of labelled rows for which ``allowed`` (over ``id``) holds, about ``rows`` at most.

    ``weight`` is how many rows of its label a row stands for. Rows without an id or a label are left out; an id labelled twice counts as toxic if any label says so.
    """
    marked = renamed(labels, id=id_col, y=label_col).where(F.col("id").isNotNull() & F.col("y").isNotNull()) \
        .where(allowed).groupBy("id").agg(F.max(F.col("y").cast("int")).alias("y"))
    texts = renamed(docs, id=id_col, text=text_col)
    present = marked.join(texts.select("id").distinct(), "id", "left_semi")
    counts = {r.y: r["count"] for r in present.groupBy("y").count().collect()}
    bound = F.lit(1.0)
    for y, n in counts.items():
        bound = F.when(F.col("y") == y, F.lit(min(1.0, rows / 2 / n))).otherwise(bound)
    share = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    chosen = present.withColumn("weight", 1 / bound).where(share < bound)
    return texts.join(F.broadcast(chosen), "id")  # at most about ``rows`` ids


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by sentence, ``(sentence, word, y)``; an empty word stands for the sentence itself."""
    for batch in batches:
        keys, words, marks = [], [], []
        for text, y in zip(as_bytes(batch.column("text")), batch.column("y").to_pylist(), strict=True):
            for sentence in set(sentences(text)):
                own = {b"", *sentence.split()}
                keys += [xxhash.xxh3_64_intdigest(sentence) >> 1] * len(own)
                words += own
                marks += [y] * len(own)
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(words, pa.binary()), pa.array(marks, pa.int32())], names=["sentence", "word", "y"])


def select_words(sample: DataFrame, size: int = VOCABULARY, least: float = LEAST_GAIN) -> list[bytes]:
    """The words whose presence speaks most for the label 1, by the log-likelihood ratio of at least ``least``.

    Each different sentence counts once, so that the copies of one document do not make its words telling.
    """
    rows = sample.select("text", F.col("y").cast("int").alias("y")).mapInArrow(_word_rows, "sentence bigint, word binary, y int")
    once = rows.groupBy("sentence", "word").agg(F.max("y").alias("y"))
    by_word = settle(once.groupBy("word").agg(
        F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b")), "words")
    total = by_word.where(F.length("word") == 0).first()
    if total is None or not total.a or not total.b:
        return []
    pos, neg = total.a, total.b

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    both, all_ = F.col("a") + F.col("b"), pos + neg
    gain = (term(F.col("a"), both * (pos / all_)) + term(F.col("b"), both * (neg / all_))
            + term(pos - F.col("a"), (all_ - both) * (pos / all_)) + term(neg - F.col("b"), (all_ - both) * (neg / all_)))
    top = by_word.where(F.length("word") > 0).withColumn("gain", gain).where((F.col("gain") >= least) & (F.col("a") * neg > F.col("b") * pos)).orderBy(F.desc("gain"), "word").limit(size)
    return [bytes(r.word) for r in top.select("word").collect()]


def _bags(words: list[bytes]):
    """Per text: label, number of sentences, and selected words by sentence."""
    index = {w: i for i, w in enumerate(words)}
    schema = pa.schema([("y", pa.int32()), ("weight", pa.float64()), ("n", pa.int32()), ("sentence", pa.list_(pa.int32())), ("word", pa.list_(pa.int32()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, sentence, word = [], [], []
        for text in as_bytes(batch.column("text")):
            parts = sentences(text)
            found = [(i, index[w]) for i, s in enumerate(parts) for w in index.keys() & set(s.split())]
            n.append(len(parts))
            sentence.append([i for i, _ in found])
            word.append([w for _, w in found])
        return pa.RecordBatch.from_arrays(
            [batch.column("y"), batch.column("weight"), *(pa.array(c, f.type) for c, f in zip((n, sentence, word), list(schema)[2:], strict=True))], schema=schema)
    return per_batch(run)


def fit(sample: DataFrame, size: int = VOCABULARY, steps: int = STEPS) -> Model:
    """Maximum likelihood through the noisy-or, with a quadratic penalty; without both classes, an indifferent model.

    What reaches the driver is bounded by the sample's rows and their selected words.
    """
    words = select_words(sample, size)
    if not words:
        return Model({}, -10.0)
    bags = sample.select(F.col("y").cast("int").alias("y"), "weight", "text").mapInArrow(
        _bags(words), "y int, weight double, n int, sentence array<int>, word array<int>").where("n > 0").toArrow()
    y, n = bags.column("y").to_numpy(), bags.column("n").to_numpy().astype(np.int64)
    weight = bags.column("weight").to_numpy() / bags.column("weight").to_numpy().sum()
    lists = [bags.column(c).combine_chunks() for c in ("sentence", "word")]
    per_bag = np.diff(lists[0].offsets.to_numpy())
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    sentence = lists[0].values.to_numpy() + np.repeat(first, per_bag)
    word = lists[1].values.to_numpy()
    # Sentences without a selected word share one score.
    hit, sentence = np.unique(sentence, return_inverse=True)
    bag = np.repeat(np.arange(len(n)), n)[hit]
    plain = n - np.bincount(bag, minlength=len(n))
    theta, bias = np.zeros(len(words)), -4.0
    m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(sentence, theta[word], minlength=len(hit))
        p, p0 = 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 / (1 + np.exp(-bias))
        clean = np.bincount(bag, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(n)) + plain * np.log1p(-p0)
        none = np.exp(np.minimum(clean, -1e-9))
        pull = np.where(y == 1, -none / (1 - none), 1.0) * weight
        dz = p * pull[bag]
        gradient = np.append(np.bincount(word, dz[sentence], minlength=len(words)) + L2 * theta,
                             dz.sum() + (plain * p0 * pull).sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-10)
        theta, bias = theta - move[:-1], bias - move[-1]
    return Model(dict(zip(words, theta.tolist(), strict=True)), float(bias))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``_score`` (0 to 1), ``_sentence`` and ``_sentence_score`` of the worst sentence.

    Null, empty and wordless texts score 0 and have no sentence. Columns of ``docs`` with one of these names give way.
    """
    docs = docs.drop("_score", "_sentence", "_sentence_score")
    bounded_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, worst, value = [], [], []
        for text in as_bytes(batch.column(text_col)):
            p = sentence_scores(text, model)
            total.append(noisy_or(p))
            worst.append(int(p.argmax()) if len(p) else None)
            value.append(float(p.max()) if len(p) else None)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(total, pa.float64()), pa.array(worst, pa.int32()), pa.array(value, pa.float64())],
            names=[*batch.schema.names, "_score", "_sentence", "_sentence_score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(per_batch(run), fields + ", _score double, _sentence int, _sentence_score double")


def below(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with their own columns alone, whatever those are called."""
    bounded_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_bytes(batch.column(text_col))
        return batch.filter(pa.array([noisy_or(sentence_scores(text, model)) < threshold for text in texts], pa.bool_()))

    return docs.mapInArrow(per_batch(run), docs.schema)


def locate(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, sentence, score, text)``: the sentences that alone reach the threshold."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(doc, i, float(p), s.decode("utf-8", "replace").strip())
                for doc, text in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text")), strict=True)
                for i, (p, s) in enumerate(zip(sentence_scores(text, model), sentences(text), strict=True)) if p >= threshold]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.float64(), pa.string()), strict=True)],
            names=["doc_id", "sentence", "score", "text"])

    texts = renamed(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    return texts.mapInArrow(per_batch(run), "doc_id bigint, sentence int, score double, text string")


def held_out(id_col: str) -> Column:
    """Rows kept from training: ``crc32`` of the id as text, modulo 3, is 1. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    bounded_batches(docs.sparkSession)
    return fit(settle(sample_labelled(docs, labels, ~held_out("id"), rows), "labelled"))
