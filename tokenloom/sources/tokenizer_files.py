"""Tokenizers on disk: tables of our own, and the public tokenizer.json layout."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bpe import BPE, WORDPIECE, Tokenizer
from ..operators.codec import MAX_UNIT_CHARS, MAX_VOCAB

BYTE_LEVEL = "ByteLevel"


def _model(tok: Tokenizer, vocab: DataFrame):
    """The model part, by kind. The lists are bounded by the vocabulary size."""
    if tok.kind == WORDPIECE:
        return vocab, F.struct(
            F.lit(WORDPIECE).alias("type"), F.lit(tok.unknown).alias("unk_token"),
            F.lit(tok.prefix).alias("continuing_subword_prefix"),
            F.lit(MAX_UNIT_CHARS).alias("max_input_chars_per_word"), F.col("vocab"))
    names = _small(tok.vocab)
    pairs = (
        tok.merges.join(names.toDF("left", "l"), "left").join(names.toDF("right", "r"), "right")
        .agg(F.sort_array(F.collect_list(F.struct("rank", F.array("l", "r").alias("pair")))).alias("ranked"))
    )
    merges = pairs.select(F.transform("ranked", lambda m: m["pair"]).alias("m")).scalar()
    return vocab, F.struct(F.lit(BPE).alias("type"), F.lit(tok.unknown).alias("unk_token"),
                           F.col("vocab"), merges.alias("merges"))


def _small(vocab: DataFrame) -> DataFrame:
    """The vocabulary for a broadcast, after a look at its size."""
    if vocab.count() > MAX_VOCAB:
        raise ValueError(f"a vocabulary has more than {MAX_VOCAB} tokens")
    return F.broadcast(vocab)


def tokenizer_json(tok: Tokenizer) -> DataFrame:
    """One row ``value``: the tokenizer in the public tokenizer.json layout, by its kind.

    A BPE model has the byte-level steps around it; a WordPiece model has none, so that a text is one unit.
    """
    ids = F.map_from_entries(F.sort_array(F.collect_list(F.struct("token", "id"))))
    vocab, model = _model(tok, tok.vocab.agg(ids.alias("vocab")))
    added = F.array(*[
        F.struct(F.element_at("vocab", F.lit(s)).alias("id"), F.lit(s).alias("content"),
                 *[F.lit(False).alias(n) for n in ("single_word", "lstrip", "rstrip", "normalized")],
                 F.lit(True).alias("special"))
        for s in tok.specials
    ])
    byte_level = F.struct(
        F.lit(BYTE_LEVEL).alias("type"), F.lit(True).alias("add_prefix_space"),
        F.lit(True).alias("trim_offsets"), F.lit(True).alias("use_regex"),
    )
    around = [byte_level.alias(n) for n in ("pre_tokenizer", "post_processor", "decoder")] if tok.kind == BPE else []
    return vocab.select(F.to_json(F.struct(
        F.lit("1.0").alias("version"), added.alias("added_tokens"), *around, model.alias("model"),
    )).alias("value"))


def write_tokenizer(tok: Tokenizer, path: str) -> str:
    """Persist vocab, merges, the model's settings and the one-row JSON export below ``path``."""
    spark = tok.vocab.sparkSession
    tok.vocab.write.parquet(f"{path}/vocab")
    tok.merges.write.parquet(f"{path}/merges")
    spark.createDataFrame(
        [(tok.kind, list(tok.specials), tok.unknown, tok.prefix)],
        "kind string, specials array<string>, unknown string, prefix string").write.parquet(f"{path}/model")
    tokenizer_json(read_tokenizer(spark, path)).write.text(f"{path}/tokenizer.json")
    return path


def read_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    model = spark.read.parquet(f"{path}/model").first()
    return Tokenizer(spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges"),
                     model.kind, tuple(model.specials), model.unknown, model.prefix)


def _check_byte_level(layout: dict) -> None:
    def steps(part: dict | None, inner: str) -> list[dict]:
        return [] if part is None else part[inner] if part["type"] == "Sequence" else [part]

    cut = steps(layout.get("pre_tokenizer"), "pretokenizers")
    if [s["type"] for s in cut] != [BYTE_LEVEL] or not cut[0].get("use_regex", True):
        raise ValueError("only byte-level BPE models can be read")
    odd = {k for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout") if layout["model"].get(k)}
    if odd or layout["model"].get("byte_fallback"):
        raise ValueError(f"BPE models with {sorted(odd) or ['byte_fallback']} can't be read")


def read_tokenizer_json(spark: SparkSession, path: str) -> Tokenizer:
    """A tokenizer from a file in the public tokenizer.json layout, of kind BPE (byte-level) or WordPiece.

    The file is as large as its vocabulary, so one row holds it. Steps that our encoder does not take (normalizers, other
    pre-tokenizers, word endings) are an error rather than other ids. Literal special tokens are those the file marks so.
    """
    layout = json.loads(spark.read.text(path, wholetext=True).first().value)
    model = layout["model"]
    kind = model.get("type") or (BPE if "merges" in model else WORDPIECE)
    if layout.get("normalizer"):
        raise ValueError("tokenizers with a normalizer can't be read")
    added = layout.get("added_tokens") or []
    ids = {**model["vocab"], **{a["content"]: a["id"] for a in added}}
    if len(ids) > MAX_VOCAB:
        raise ValueError(f"a vocabulary has more than {MAX_VOCAB} tokens")
    merges: list[tuple[int, int, int, int]] = []
    if kind == BPE:
        _check_byte_level(layout)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges.append((rank, ids[left], ids[right], ids[left + right]))
    elif kind != WORDPIECE:
        raise ValueError(f"tokenizers of kind {kind} can't be read")
    elif layout.get("pre_tokenizer"):
        raise ValueError("WordPiece models with a pre-tokenizer can't be read")
    return Tokenizer(
        spark.createDataFrame(sorted((i, t) for t, i in ids.items()), "id int, token string"),
        spark.createDataFrame(merges, "rank int, left int, right int, new_id int"), kind,
        tuple(a["content"] for a in added if a.get("special")), model.get("unk_token") or "",
        model.get("continuing_subword_prefix") or "##")
