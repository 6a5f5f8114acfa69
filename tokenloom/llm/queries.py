"""One query per operator, over its whole table, with the columns that can be compared."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import (
    bytebpe, codes, licences, minhash, oracles, packing, pivots, resampling, sharding, simhash, suffixes, tokens, toxicity, urls,
)

SHARDS = 8
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"), width=3, percent=85)


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), WORD_TOKENIZER)


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf, "documents"), PIECE_MODEL)


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf, "documents"), SHARDS)


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = bytebpe.encode_documents(table(spark, sf, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_urls(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_pages(table(spark, sf, "pages"), URL_RULES)


def op7_pivots(spark: SparkSession, sf: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf, "embeddings"))


def op8_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf, "documents"))
    kept = F.octet_length("kept")
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - kept).alias("n_removed"),
        F.expr("size(spans) div 2").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf, "documents"))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.col("_sentence").alias("worst_sentence"), F.col("_sentence_score").alias("worst_score"))


def op11_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codes.vector_codes(table(spark, sf, "embeddings"))


def op12_licences(spark: SparkSession, sf: str) -> DataFrame:
    return licences.scan(table(spark, sf, "documents"))


def op13_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_packing, op3_token_counts, op4_sharding, op5_byte_bpe, op6_urls, op7_pivots, op8_suffixes,
    op9_simhash, op10_toxicity, op11_codes, op12_licences, op13_resampling)}
ORACLES: dict[str, str] = {"op11_codes": oracles.vector_codes(), "op13_resampling": oracles.resampling()}
