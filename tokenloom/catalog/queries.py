"""One query per operator. Arrays come out as joined strings and integers as bigint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import VOCAB_SIZE
from ..functions.labels import argmax, map_labels
from ..functions.text import strip_blank_lines
from ..operators import batches, bpe, codec, counts, ngrams, ordering, packing, tagging
from ..plans.corpus import make_examples
from ..plans.pretraining import training_batches
from ..plans.tagging import evaluate
from ..session import scratch_path, table, written
from ..sources import files, texts, tokenizer_files, tokens
from . import inputs

BLOCK = 128
SHORT_TRIM = 16
WHOLE_LINES = 1 << 30  # no line is longer
MASK_KEYS = ("file", "doc_id", "ex_idx")


def flat(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), " ")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _lines(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("doc_id", "line")


def _write_jsonl(spark: SparkSession, df: DataFrame, key: str, *columns: str) -> str:
    """JSON lines below one folder per file, in the order of ``key``."""
    path = scratch_path(spark, "jsonl")
    df.orderBy("file", key).select("file", F.to_json(F.struct(*columns)).alias("value")).write.partitionBy("file").text(path)
    return path


def _write_sents(spark: SparkSession, sf: str, damaged: bool) -> str:
    """Sentence files; with ``damaged``, some are cut short and some lack the attribute."""
    good = F.to_json(F.struct("sents"))
    value = good
    if damaged:
        digit = F.substring(F.md5("file"), 1, 1)
        value = (
            F.when(digit < "4", F.expr("left(to_json(struct(sents)), length(to_json(struct(sents))) - 2)"))
            .when(digit < "8", F.to_json(F.struct(F.col("sents").alias("lines")))).otherwise(good)
        )
    path = scratch_path(spark, "sents")
    inputs.sentence_files(spark, sf).select("file", value.alias("value")) \
        .write.partitionBy("file").text(path)
    return path


# Sources and sinks


def read_jsonl_attr(spark, sf):
    path = _write_jsonl(spark, inputs.corpus(spark, sf), "doc_id", "doc_id", "text")
    return _lines(texts.read_jsonl_attr(spark, path))


def read_json_list_attr(spark, sf):
    return flat(texts.read_json_list_attr(spark, _write_sents(spark, sf, False)))


def read_tolerant_sents(spark, sf):
    return flat(texts.read_tolerant(spark, _write_sents(spark, sf, True))[0])


def read_tolerant_rejects(spark, sf):
    return texts.read_tolerant(spark, _write_sents(spark, sf, True))[1]


def read_tolerant_report(spark, sf):
    return texts.read_tolerant(spark, _write_sents(spark, sf, True))[2]


def select_files(spark, sf):
    root = tokens.write_token_lists(inputs.encoded(spark, sf), scratch_path(spark, "lists"))
    chosen = files.select_files(tokens.read_token_lists(spark, root), "src1", "src12")
    return flat(chosen.select("file", F.size("ids").alias("n")))


def read_token_lists(spark, sf):
    both = inputs.encoded(spark, sf)
    roots = [
        tokens.write_token_lists(part, scratch_path(spark, "lists"))
        for part in (both.filter("file < 'src2'"), both.filter("file >= 'src2'"))
    ]
    # A common base path is not needed: each root is read with its own partition column.
    parts = [tokens.read_token_lists(spark, root) for root in roots]
    return flat(_lines(parts[0].unionByName(parts[1])))


def write_token_lists(spark, sf):
    root = tokens.write_token_lists(inputs.encoded(spark, sf), scratch_path(spark, "lists"))
    return flat(_lines(tokens.read_token_lists(spark, root)))


def write_token_matrix(spark, sf):
    root = tokens.write_token_matrix(inputs.encoded(spark, sf), scratch_path(spark, "matrices"))
    return flat(_lines(tokens.read_token_matrix(spark, root)))


def _matrix(spark, sf):
    """One array of arrays per file of at most ``DOCS_PER_FILE`` documents."""
    bucket = F.expr(f"doc_id div {inputs.DOCS_PER_FILE}")
    rows = inputs.encoded(spark, sf).groupBy(F.concat_ws("_", "file", bucket).alias("file")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "ids"))).alias("d"))
    path = scratch_path(spark, "matrix")
    rows.select("file", F.to_json(F.transform("d", lambda d: d["ids"])).alias("value")) \
        .write.partitionBy("file").text(path)
    return tokens.read_token_matrix(spark, path)


def read_token_matrix(spark, sf):
    return flat(_lines(_matrix(spark, sf)))


def write_split(spark, sf):
    path = scratch_path(spark, "split")
    examples = written(inputs.examples(spark, sf), "examples")  # their keys and lengths are read several times
    examples = ordering.file_parts(ordering.split_head(examples), MASK_KEYS)
    tokens.write_split(examples, path, "_trim", MASK_KEYS, in_order=True)
    return flat(tokens.read_token_lists(spark, path).select("split", "ids"))


def read_labelled(spark, sf):
    path = _write_jsonl(spark, inputs.tagged(spark, sf).withColumn("file", F.lit("tagged")),
                        "sent_id", "token", "ner")
    return flat(texts.read_labelled(spark, path))


def write_tokenizer(spark, sf):
    path = tokenizer_files.write_tokenizer(inputs.trained(spark, sf), scratch_path(spark, "tok"))
    return flat(tokenizer_files.read_tokenizer(spark, path).vocab)


def append_sample_log(spark, sf):
    path = scratch_path(spark, "log")
    words = F.transform(F.split("text", "\n"), lambda x: F.split(x, " "))
    samples = inputs.corpus(spark, sf).select("doc_id", words.alias("samples"))
    for half in (0, 1):
        texts.append_sample_log(samples.filter(F.col("doc_id") % 2 == half), path)
    return spark.read.text(path)


# Projections and scalar functions


def strip_blank(spark, sf):
    return inputs.spaced_turns(spark, sf).withColumn("text", strip_blank_lines(F.col("text")))


def drop_source_columns(spark, sf):
    tagged = inputs.tagged(spark, sf)
    mapped = tagged.withColumn("labels", map_labels(F.col("ner")))
    return flat(tagging.drop_source_columns(mapped, ["token", "ner"]))


def map_label_names(spark, sf):
    return flat(inputs.tagged(spark, sf).select("sent_id", map_labels(F.col("ner")).alias("labels")))


def argmax_label(spark, sf):
    scored = inputs.predictions(spark, sf)
    return flat(scored.select("sent_id", "pos", argmax(F.col("logits")).alias("pred")))


def _sentences(spark, sf):
    return tagging.drop_ignored(tagging.sentence_predictions(inputs.predictions(spark, sf)))


def drop_ignored(spark, sf):
    return flat(_sentences(spark, sf))


def format_pairs(spark, sf):
    return tagging.format_pairs(inputs.tagged(spark, sf), "token", "ner")


# Tokenizer


def word_counts(spark, sf):
    return bpe.word_counts(inputs.documents(spark, sf))


def initial_vocab(spark, sf):
    return flat(bpe.initial_vocab(bpe.word_counts(inputs.documents(spark, sf))))


def pair_counts(spark, sf):
    words = bpe.byte_words(bpe.word_counts(inputs.documents(spark, sf)))
    return flat(bpe.pair_counts(words))


def bpe_train(spark, sf):
    return flat(inputs.trained(spark, sf).merges)


def wordpiece_train(spark, sf):
    return flat(inputs.trained_wordpiece(spark, sf).vocab)


def encode_wordpiece(spark, sf):
    found = codec.encode(inputs.lines(spark, sf), inputs.trained_wordpiece(spark, sf), max_chars=WHOLE_LINES)
    return flat(found.select("doc_id", "line", "ids"))


def decode_wordpiece(spark, sf):
    """Encode and decode; the line comes back."""
    tok = inputs.trained_wordpiece(spark, sf)
    found = codec.encode(inputs.lines(spark, sf), tok, max_chars=WHOLE_LINES).select("doc_id", "line", "ids")
    return flat(codec.decode(found, tok).select("doc_id", "line", "text"))


def read_tokenizer_json(spark, sf):
    """The merges of a tokenizer written in the public layout and read again."""
    path = tokenizer_files.write_tokenizer(inputs.trained(spark, sf), scratch_path(spark, "tok"))
    return flat(tokenizer_files.read_tokenizer_json(spark, f"{path}/tokenizer.json").merges)


def encode(spark, sf):
    found = codec.encode(inputs.marked(spark, sf), inputs.trained(spark, sf))
    return flat(found.select("doc_id", "ids"))


def encode_bytes(spark, sf):
    found = codec.encode(inputs.marked(spark, sf), bpe.byte_tokenizer(spark))
    return flat(found.select("doc_id", "ids"))


def decode(spark, sf):
    """Encode and decode; with special tokens kept, the text comes back unchanged."""
    tok = inputs.trained(spark, sf)
    found = codec.encode(inputs.marked(spark, sf), tok).select("doc_id", "ids")
    both = codec.decode(found, tok, out="text", skip_special_tokens=False)
    return codec.decode(both, tok, out="plain").select("doc_id", "text", "plain")


# Packing


def split_at_eos(spark, sf):
    return flat(packing.split_at_eos(inputs.encoded(spark, sf)))


def pack_trim(spark, sf):
    return flat(inputs.examples(spark, sf))


def pack_trim_short(spark, sf):
    return flat(inputs.examples(spark, sf, SHORT_TRIM))


def chunk_block(spark, sf):
    return flat(packing.chunk_block(inputs.encoded(spark, sf), BLOCK))


def pack_none(spark, sf):
    return flat(_lines(packing.pack_none(_matrix(spark, sf))))


# Order and splits


def shuffle_rows(spark, sf):
    return flat(ordering.shuffle_rows(inputs.examples(spark, sf)).drop("ids"))


def shuffle_files(spark, sf):
    return flat(ordering.shuffle_files(inputs.examples(spark, sf)).drop("ids"))


def split_head(spark, sf):
    return flat(ordering.split_head(inputs.examples(spark, sf)).drop("ids"))


def split_head_shuffled(spark, sf):
    return flat(ordering.split_head(inputs.examples(spark, sf), shuffle=True).drop("ids"))


def split_fraction(spark, sf):
    return flat(ordering.split_fraction(inputs.tagged(spark, sf)).select("sent_id", "split"))


def top_k(spark, sf):
    words = inputs.corpus(spark, sf).select(
        "file", F.explode(F.split("text", "[ \n]")).alias("word"))
    ranked = words.groupBy("file", "word").agg(F.count(F.lit(1)).alias("n"))
    return flat(ordering.top_k(ranked, ["file"], [F.desc("n"), "word"]))


# Batches


def batch_pad(spark, sf):
    return flat(batches.ordered_batches(inputs.examples(spark, sf), ordering.file_positions, MASK_KEYS))


def clm_labels(spark, sf):
    padded = batches.ordered_batches(inputs.examples(spark, sf), ordering.shuffle_rows, MASK_KEYS)
    return flat(batches.clm_labels(padded))


def mlm_mask(spark, sf):
    return flat(batches.mlm_mask(inputs.examples(spark, sf), VOCAB_SIZE, MASK_KEYS))


def whole_word_mask(spark, sf):
    """Every id that is not a multiple of three begins a word here."""
    masked = batches.whole_word_mask(
        inputs.examples(spark, sf), VOCAB_SIZE, MASK_KEYS, lambda i: i % 3 != 0)
    return flat(masked)


def whole_word_mask_trained(spark, sf):
    """Words begin at tokens with the space mark."""
    tok = inputs.trained(spark, sf)
    found = codec.encode(inputs.marked(spark, sf), tok).select("file", "doc_id", "ids")
    masked = batches.whole_word_mask(
        packing.pack_trim(found, 512), inputs.TRAINED_SIZE, MASK_KEYS, codec.word_start_test(tok))
    return flat(masked)


def tokcls_pad(spark, sf):
    aligned = tagging.align_labels(inputs.tagged(spark, sf), bpe.byte_tokenizer(spark))
    return flat(batches.tokcls_pad(aligned, place=ordering.shuffle_rows))


def fit_length(spark, sf):
    rows = inputs.encoded(spark, sf).select("doc_id", "ids")
    return flat(batches.fit_length(rows, 514))


# Word tagging


def align_labels(spark, sf):
    aligned = tagging.align_labels(inputs.tagged(spark, sf), inputs.trained(spark, sf), max_len=256)
    return flat(aligned.drop("token", "ner"))


def align_labels_bytes(spark, sf):
    aligned = tagging.align_labels(inputs.tagged(spark, sf), bpe.byte_tokenizer(spark))
    return flat(aligned.drop("token", "ner"))


def entity_spans(spark, sf):
    return flat(tagging.entity_spans(_sentences(spark, sf)))


def span_scores(spark, sf):
    return evaluate(inputs.predictions(spark, sf))


# N-grams and counters


def fill_slot_topk(spark, sf):
    return flat(ngrams.fill_slot_topk(inputs.encoded(spark, sf)))


def next_token_distribution(spark, sf):
    shares = ngrams.next_token_distribution(inputs.encoded(spark, sf))
    return flat(shares.withColumn("p", F.round("p", 6)))


def sample_next(spark, sf):
    return flat(ngrams.sample_next(inputs.encoded(spark, sf)))


def repeated_ngrams(spark, sf):
    return flat(ngrams.repeated_ngrams(inputs.encoded(spark, sf)))


def corpus_counts(spark, sf):
    sentences = F.size(F.split("text", "\n"))
    rows = inputs.encoded(spark, sf, "text")
    return flat(counts.corpus_counts(rows, sentences, packing.count_packed(F.col("ids"), 512)))


def map_batches(spark, sf):
    def add_words(batch):
        batch["words"] = batch["text"].str.count(" ") + 1
        return batch

    rows = table(spark, sf, "documents").select("doc_id", "text")
    return codec.map_batches(rows, add_words, "words bigint").select("doc_id", "words")


# Whole jobs


def corpus_to_splits(spark, sf):
    """Encoded texts -> sentence packing -> shuffle -> dev and train, counted per split."""
    examples = make_examples(inputs.encoded(spark, sf), trim=512, shuffle=True)
    return examples.groupBy("split").agg(
        F.count(F.lit(1)).alias("examples"), F.sum(F.size("ids")).alias("tokens"))


def pretraining_batches(spark, sf):
    """Examples -> whole-word masks -> shuffled, padded batches of one epoch."""
    return flat(training_batches(inputs.examples(spark, sf), VOCAB_SIZE, MASK_KEYS, starts=lambda i: i % 3 != 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        read_jsonl_attr, read_json_list_attr, read_tolerant_sents, read_tolerant_rejects,
        read_tolerant_report, select_files, read_token_lists, read_token_matrix,
        write_token_lists, write_token_matrix, write_split, read_labelled, write_tokenizer, append_sample_log,
        strip_blank, drop_source_columns, map_label_names, argmax_label, drop_ignored,
        format_pairs, word_counts, initial_vocab, pair_counts, bpe_train, wordpiece_train, encode_wordpiece, decode_wordpiece, read_tokenizer_json,
        encode, encode_bytes, decode, split_at_eos, pack_trim, pack_trim_short, chunk_block,
        pack_none, shuffle_rows, shuffle_files, split_head, split_head_shuffled,
        split_fraction, top_k, batch_pad, clm_labels, mlm_mask, whole_word_mask,
        whole_word_mask_trained, tokcls_pad, fit_length, align_labels, align_labels_bytes,
        entity_spans, span_scores, fill_slot_topk, next_token_distribution, sample_next,
        repeated_ngrams, corpus_counts, map_batches, corpus_to_splits, pretraining_batches,
    )
}
